"""The lookup tables and the lookups."""

from __future__ import annotations

import random
import re

import pytest
from builders import body, channels, message, messages

from orderloom.config import JobConfig
from orderloom.operators import dimensions as d
from orderloom.operators import enrich as e
from orderloom.operators.messages import order_headers
from orderloom.plans.order_lines import build
from orderloom.session import any_path


def stores(spark, pairs, **kw):
    return {r.brand_id: r.official_store for r in d.master_store(channels(spark, pairs), **kw).collect()}


def marketplaces(spark, pairs, **kw):
    return {r.mp_code: r.marketplace for r in d.master_marketplace(channels(spark, pairs), **kw).collect()}


def test_split(spark):
    rows = d.oms_channel_clean(
        channels(spark, [(" BR1 _ SHPE ", "Shopee - My-Store "), (" BR1 _ SHPE ", "Shopee - My-Store "), ("ABC", "X")])
    ).collect()
    assert sorted(map(tuple, rows)) == [("ABC", "abc", "X", "X"), ("BR1", "shpe", "Store", "Shopee")]


def test_several_marks(spark):
    (row,) = d.split_channels(channels(spark, [("A_B_C", "m-n-o")])).collect()
    assert tuple(row) == ("A", "c", "o", "m")


@pytest.mark.parametrize("word", ["request", "InterCo", "CSR", "nonevent", "RECLASS", "Non Event", "xofflinex"])
def test_excluded_channels(spark, word):
    assert stores(spark, [(f"BR1_{word}", "m-s"), ("BR2_a", "m-s"), (None, "m-s")]) == {"BR2": "s"}


def test_b2b_without_dash_uses_the_code(spark):
    assert stores(spark, [("BR1_SHPE", "B2B JNS Store")]) == {"BR1": "SHPE"}
    assert stores(spark, [("BR1_SHPE", "B2B Beauty - Shop")]) == {"BR1": "Shop"}
    assert stores(spark, [("BR1_SHPE", "b2b jns store")]) == {"BR1": "b2b jns store"}
    assert stores(spark, [("BR1_SHPE", "b2b jns store")], case_insensitive=True) == {"BR1": "SHPE"}


def test_store_is_chosen_before_cleaning(spark):
    # `b!` is greater than `a~`; after cleaning only letters remain.
    assert stores(spark, [("BR1_x", "m-b!"), ("BR1_x", "m-a~")]) == {"BR1": "b"}


def test_store_names(spark):
    pairs = [("A_x", "m-Sleek Baby"), ("B_x", "m-ELLIPS hair"), ("C_x", "m- Shop [1]! & (Co)"), ("D_x", "m-a Sleek")]
    assert stores(spark, pairs) == {
        "A": "Kino Baby & Kids Official Store",
        "B": "Kino Hair & Beauty Care Official Store",
        "C": "Shop 1 & (Co)",
        "D": "a Sleek",
    }


def test_empty_store_stays_and_no_store_goes(spark):
    assert stores(spark, [("A_x", "Lazada - "), ("B_x", None)]) == {"A": ""}


def test_marketplace_takes_the_greatest(spark):
    pairs = [("A_SHPE", "Shopee-a"), ("B_shpe", "Shopee Mall-b"), ("C_LZDA", None)]
    assert marketplaces(spark, pairs) == {"shpe": "Shopee Mall", "lzda": None}


def test_any_case(spark):
    pairs = [("br1_x", "m-beta"), ("BR1_x", "m-Zeta"), ("Br1_x", "m-alpha")]
    assert stores(spark, pairs) == {"br1": "beta", "BR1": "Zeta", "Br1": "alpha"}
    assert stores(spark, pairs, case_insensitive=True) == {"BR1": "Zeta"}


def test_aggregate_and_window_agree_on_a_hot_brand(spark):
    rng = random.Random(3)
    pairs = [
        (f"BR{0 if rng.random() < 0.34 else rng.randrange(50)}_{rng.choice(['a', 'B', 'offline'])}",
         rng.choice([None, "m-", "m-Sleek 1", "n", f"m-s{rng.randrange(99)}"]))
        for _ in range(3000)
    ]
    df = channels(spark, pairs)
    for agg, window in (
        (d.master_store(df), d.master_store_windowed(df)),
        (d.master_marketplace(df), d.master_marketplace_windowed(df)),
    ):
        assert sorted(map(str, agg.collect())) == sorted(map(str, window.collect()))


def test_dimension_checks(spark):
    def pairs(rows):
        return spark.createDataFrame(rows, "k string, v string")

    assert d.dimension(pairs([("a", "1"), ("b", "1")]), "k", "v").count() == 2
    with pytest.raises(ValueError, match="repeats keys.*a"):
        d.dimension(pairs([("a", "1"), ("a", "2")]), "k", "v")
    with pytest.raises(ValueError, match="NULL"):
        d.dimension(pairs([("a", None)]), "k", "v")


CHANNELS = [("BR1_SHPE", "Shopee - Official"), ("O'X_LZDA", "Lazada - Quoted"), ("E_TKPD", "Tokopedia - ")]


def looked_up(spark, *values, limit=JobConfig().broadcast_limit):
    store, marketplace = d.channel_lookups(channels(spark, CHANNELS), limit)
    rows = e.enrich(order_headers(messages(spark, values)), store, marketplace)
    return [(r.shop_name, r.marketplace) for r in rows.orderBy("message_seq").collect()]


@pytest.mark.parametrize("limit", [JobConfig().broadcast_limit, 0])
def test_lookups(spark, limit):
    cases = [
        (body(), ("Official", "Shopee")),
        (body(brand_id="other", order={"channel_code": "other"}), ("Shop", "null")),
        # The key is looked up with its quotes doubled.
        (body(brand_id="O'X", order={"channel_code": "lzda"}), ("Shop", "Lazada")),
        # Codes are matched as they come; the table's are in lower case.
        (body(order={"channel_code": "SHPE"}), ("Official", "null")),
        # An empty store name is a hit.
        (body(brand_id="E", order={"channel_code": "tkpd"}), ("", "Tokopedia")),
        (body(brand_id=None, order={"channel_code": None}), ("Shop", "null")),
    ]
    got = looked_up(spark, *[message(b) for b, _ in cases], limit=limit)
    assert got == [want for _, want in cases]


def test_unmatched_marketplace_as_null(spark):
    cfg = JobConfig(null_text=None)
    value = message(body(order={"channel_code": "other"}))
    (row,) = build(messages(spark, [value]), channels(spark, CHANNELS), cfg).collect()
    assert row.marketplace is None


def test_size_decides_about_broadcast(spark):
    df = channels(spark, CHANNELS)
    small = d.channel_lookups(df, 10_000)
    assert [x.small for x in small] == [True, True]
    assert [x.small for x in d.channel_lookups(df, 100)] == [False, False]
    assert d.channel_lookups(df.limit(0), 0)[0].small


def read_stores(pairs):
    """The store table, row by row."""
    best = {}
    for code, name in pairs:
        if code is None or re.search("request|interco|csr|nonevent|reclass|non event|offline", code.lower()):
            continue
        if name is None:
            continue
        b2b = re.search("B2B Beauty|B2B JNS|B2BJNS", name) and "-" not in name
        store = (code.rsplit("_", 1)[-1] if b2b else name.rsplit("-", 1)[-1]).strip(" ")
        brand = code.split("_", 1)[0].strip(" ")
        best[brand] = max(best.get(brand, store), store, key=lambda s: s.encode())
    return {brand: clean(store) for brand, store in best.items()}


def clean(store):
    low = store.lower()
    if low.startswith("sleek"):
        return "Kino Baby & Kids Official Store"
    if low.startswith("ellip"):
        return "Kino Hair & Beauty Care Official Store"
    return re.sub("[^-0-9A-Za-z&() ]", "", store).strip(" ")


def test_random_channels(spark):
    rng = random.Random(5)
    parts = ["A", "b", "_", "-", " ", "B2B JNS", "Sleek", "ellips", "!", "é", "(x)", "&", "OFFline", "csr", "9"]

    def text():
        return None if rng.random() < 0.03 else "".join(rng.choice(parts) for _ in range(rng.randrange(6)))

    pairs = [(text(), text()) for _ in range(4000)]
    want = read_stores(pairs)
    assert len(want) > 100
    assert stores(spark, pairs) == want


# --- versions


def test_fingerprint_is_of_the_rows_in_any_order(spark):
    pairs = [("a_b", "x-y"), ("a_b", "x-y"), (None, "x"), ("x", None), ("", "")]
    mark = d.fingerprint(channels(spark, pairs))
    assert d.fingerprint(channels(spark, pairs[::-1]).repartition(3)) == mark
    others = [pairs[1:], [*pairs, ("a_b", "x-y")], [("x", None), *pairs[:3], ("", "")][1:], [(n, c) for c, n in pairs]]
    assert mark not in [d.fingerprint(channels(spark, p)) for p in others]
    assert d.fingerprint(channels(spark, pairs).limit(0))[0] == 0


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_versions_are_made_on_change_only(spark, limit):
    versions = d.LookupVersions(limit)
    first = versions.of(channels(spark, CHANNELS))
    assert versions.of(channels(spark, CHANNELS[::-1])) is first
    assert {r.official_store for r in first[0].rows.collect()} == {"Official", "Quoted", ""}
    second = versions.of(channels(spark, CHANNELS[:1]))
    assert second is not first and [tuple(r) for r in second[0].rows.collect()] == [("BR1", "Official")]
    # The one before is gone, folder and table.
    for path in [p for lookup in first for p in lookup.paths]:
        assert not any_path(spark, path) and not spark.catalog.tableExists(path.rsplit("/", 1)[-1].replace("-", "_"))
    assert all(any_path(spark, p) for lookup in second for p in lookup.paths)
