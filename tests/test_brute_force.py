"""Gold tables against plain Python over random small shops."""

import re
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

from conftest import ShopFrames
from hypothesis import HealthCheck, given, settings as hypo, strategies as st

from tierstone.plans import gold, silver

AS_OF = datetime(2024, 1, 31)
ids = st.one_of(st.none(), st.integers(1, 4))
moments = st.integers(-2, 60).map(lambda hours: AS_OF - timedelta(hours=hours))
cents = st.integers(-500, 500).map(lambda c: str(Decimal(c) / 100))
urls = st.sampled_from(["/about", "/a/b/1", "/cart/2", "/products/1", "/products/2", "/products/3", "/3", None])
purchases = st.lists(st.tuples(ids, ids, ids, st.integers(1, 5), cents, moments), max_size=12)
views = st.lists(st.tuples(ids, urls, st.sampled_from(["x", "y", None]), moments), max_size=25)
quick = hypo(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def parse(url):
    if url is None or not (tail := re.search(r"/(\d+)$", url)):
        return None
    page = re.match(r"^/([^/]+)/\d+$", url)
    return (page.group(1) if page else ""), int(tail.group(1))


@quick
@given(sales=purchases, seen=views)
def test_item_performance(spark, sales, seen):
    shop = ShopFrames(spark)
    items = shop.items((1, "a", "c", "1.00"), (2, "b", "c", "1.00"), (3, None, None, None))
    expected = {}
    for item in (1, 2, 3):
        mine = [s for s in sales if s[2] == item]
        viewed = sum(1 for v in seen if parse(v[1]) == ("products", item))
        orders = sum(1 for s in mine if s[0] is not None)
        rate = 0.0 if not viewed else (orders / viewed if mine else None)
        earned = sum((s[3] * Decimal(s[4]) for s in mine), Decimal(0))
        expected[item] = (sum(s[3] for s in mine), orders, earned, viewed, rate)
    for facts in (
        silver.priced(shop.purchases(*sales)),
        silver.purchases_enriched(shop.purchases(*sales), shop.users(), items),
    ):
        df = gold.item_performance(silver.items(items), facts, silver.item_views(shop.pageviews(*seen)))
        assert {r[0]: tuple(r)[3:] for r in df.collect()} == expected


@quick
@given(sales=purchases)
def test_top_sellers_and_hours(spark, sales):
    shop = ShopFrames(spark)
    names = {1: "a", 2: "b"}
    items = shop.items(*[(k, v, "c", "1.00") for k, v in names.items()])
    totals, hours = defaultdict(Decimal), defaultdict(Decimal)
    for s in sales:
        totals[s[2]] += s[3] * Decimal(s[4])
        if AS_OF - timedelta(hours=24) <= s[5] <= AS_OF:
            hours[s[5].hour] += s[3] * Decimal(s[4])
    ranked = sorted(totals.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or 0))[:3]
    priced = silver.priced(shop.purchases(*sales))
    top = gold.top_selling_items(priced, items, k=3).collect()
    assert [(r["item_id"], r["item_name"], r["total_revenue"]) for r in top] == [
        (k, names.get(k), v) for k, v in ranked]
    assert [tuple(r) for r in gold.sales_performance_24h(priced, AS_OF).collect()] == sorted(hours.items())


@quick
@given(seen=views)
def test_segments_and_channels(spark, seen):
    shop = ShopFrames(spark)
    users = silver.users(shop.users(
        (1, "A", "B", "a@example.com"), (2, "C", "D", None), (3, "E", "F", "nope"), (4, None, None, "g@h.io")))
    expected = set()
    for user, mail, name in ((1, "a@example.com", "A B"), (4, "g@h.io", "")):
        mine = [v[3].date() for v in seen if v[0] == user and parse(v[1]) and v[3] <= AS_OF]
        last = max(mine, default=None)
        idle = (AS_OF.date() - last).days if last else None
        label = "low_engagement"
        if last and len(mine) >= 8 and idle <= 3:
            label = "high_engagement"
        elif last and len(mine) >= 3 and idle <= 7:
            label = "medium_engagement"
        expected.add((user, mail, name, len(mine), len(set(mine)), last, idle, label))
    hits = silver.item_views(shop.pageviews(*seen))
    assert {tuple(r) for r in gold.user_engagement_segments(users, hits, AS_OF).collect()} == expected
    channels = defaultdict(int)
    for v in seen:
        channels[v[2]] += parse(v[1]) is not None
    assert {tuple(r) for r in gold.pageviews_by_channel(hits).collect()} == {
        (k, n) for k, n in channels.items() if n}
