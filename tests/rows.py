"""Rows of the visit log for the tests."""

ACTION_SCHEMA = ("date string, user_id bigint, session_id string, page_id bigint, "
                 "action_time string, search_keyword string, click_category_id bigint, "
                 "click_product_id bigint, order_category_ids string, order_product_ids string, "
                 "pay_category_ids string, pay_product_ids string, city_id bigint, event_id bigint")


def action(session="s1", t="2024-01-01 00:00:00", page=1, kw=None, ccat=-1, cprod=-1,
           ocats=None, oprods=None, pcats=None, pprods=None, user=1, city=0, eid=0):
    return (t[:10], user, session, page, t, kw, ccat, cprod, ocats, oprods, pcats, pprods,
            city, eid)
