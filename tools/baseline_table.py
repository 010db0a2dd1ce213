
import json
import sys

d = json.loads(sys.stdin.read())
print("| key | sec | rows |\n| --- | --- | --- |")
for k, v in d["queries"].items():
    if k == "stream_pipeline":
        continue
    print(f"| {k} | {v:.3f} | {d['rows'].get(k, 0):,} |")
print(f"| **all batch queries** | **{d['value']:.3f}** | |")
if "stream_pipeline" in d["queries"]:
    print(f"| stream pipeline (stage 1 + 2, 60 micro-batches of 12 h) | "
          f"{d['queries']['stream_pipeline']:.1f} | {d['stream_input_rows']:,} in; "
          f"{d['stream_rows_per_sec']:,.0f} rows/s |")
