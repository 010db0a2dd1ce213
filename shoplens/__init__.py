"""shoplens: shop visit-log and ad-click analytics as Spark DataFrame jobs.

Layout
------
- ``sources``   readers, adapters from the given tables, writers (sinks)
- ``functions`` column expressions (scalar helpers, JVM-side built-ins only)
- ``operators`` reusable DataFrame operators (sized broadcast, ordered
  successor pairs, top-n per group, proportional sampling, city remark,
  blacklist closed form)
- ``plans``     the ten questions, each a function DataFrame -> DataFrame
- ``streaming`` Structured Streaming twins of the ad-click questions
"""

from shoplens.params import Condition

__all__ = ["Condition"]
