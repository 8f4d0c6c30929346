"""Against all windows of all documents."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from coursetide.llm import decontaminate as dc

from .data import awkward, documents, prose


def split(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(words, k):
    return Counter(tuple(words[p : p + k]) for p in range(len(words) - k + 1))


def plain(rows, items, threshold=0.8):
    found = set()
    for i, text in rows:
        words = split(text)
        for item, item_text in items:
            own = split(item_text)
            if not own:
                continue
            k = min(5, len(own))
            bag = shingles(own, k)
            best = None
            for s in range(len(words) - len(own) + 1):
                window = shingles(words[s : s + len(own)], k)
                both = sum((bag & window).values())
                alike = both / (sum(bag.values()) + sum(window.values()) - both)
                if alike >= threshold and (best is None or alike > best[1]):
                    best = (s + 1, alike)
            if best:
                found.add((i, item, best[0], round(best[1], 9)))
    return found


def found(docs, items, **more):
    rows = dc.contaminated(docs, items, **more).collect()
    assert len({(r.doc_id, r.text_hash, r.item_id) for r in rows}) == len(rows)
    return {(r.doc_id, r.item_id, r.start, round(r.similarity, 9)) for r in rows}


ITEMS = [(1, prose(500, 60)), (2, prose(501, 20)), (3, "One, TWO three!"), (4, None), (5, ""), (6, "a a a a a a a a"), (7, prose(500, 60))]


def rows():
    item = prose(500, 60).split()
    near = [*item[:30], "changed", *item[31:]]
    far = [w if k % 9 else "other" for k, w in enumerate(item)]
    swapped = [*item[:2], "new", *item[2:]]
    out = [(i, t if t is None else t[:3000]) for i, t in awkward()]
    out += [(50, f"before {prose(500, 60).upper()}, after"), (51, " ".join(near)), (52, " ".join(far)), (53, " ".join(swapped))]
    out += [(54, f"{prose(9, 40)}\n{prose(501, 20)}. {prose(501, 20)}"), (55, "so one two three"), (56, "b a a a a a a a a a c")]
    out += [(57, " ".join(item[:58])), (58, prose(501, 20)), (58, prose(501, 20)), (58, prose(1, 30)), (None, prose(501, 20))]
    return out


@pytest.mark.parametrize("limit", [dc.BROADCAST_ROWS, 0])
def test_equals_all_windows(spark, monkeypatch, limit):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", limit)
    items = spark.createDataFrame([(*r, "own") for r in ITEMS], "item_id long, text string, h string")
    docs = documents(spark, rows(), clash=True)
    want = plain(rows(), ITEMS)
    assert len(want) > 10
    assert found(docs, items) == want
    assert found(docs, items, threshold=0.6) == plain(rows(), ITEMS, 0.6)


def test_without(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, rows(), clash=True)
    left = dc.without(docs, dc.contaminated(docs, items))
    bad = {(i, t) for i, t in rows() if plain([(i, t)], ITEMS)}
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(r for r in rows() if r not in bad)


def test_no_documents_or_items(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, rows())
    assert found(documents(spark, []), items) == set()
    assert found(docs, items.limit(0)) == set()
    assert found(docs, items.where("text is null")) == set()
    assert dc.without(docs, dc.contaminated(docs, items.limit(0))).count() == len(rows())


def test_near_values_cover_the_radius():
    """Of 8 parts, one has at most 2 of 23 differing bits."""
    assert dc.RADIUS < dc.BLOCKS * (dc.NEAR + 1)


def test_documents_shorter_than_the_item(spark):
    """All windows of 60 words, or the whole of a shorter document."""
    item = prose(500, 60).split()
    more = rows() + [(70 + k, " ".join(item[: 60 - k])) for k in range(20)] + [(100 + k, " ".join(item[k:])) for k in range(1, 20)]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for threshold in (0.8, 0.6):
        want = plain(more, ITEMS, threshold)
        for i, text in more:
            words = split(text)
            for n, own in ((n, split(t)) for n, t in ITEMS):
                k = min(5, len(own))
                if own and k <= len(words) < len(own):
                    bag, window = shingles(own, k), shingles(words, k)
                    both = sum((bag & window).values())
                    alike = both / (sum(bag.values()) + sum(window.values()) - both)
                    if alike >= threshold:
                        want.add((i, n, 1, round(alike, 9)))
        assert found(documents(spark, more), items, short=True, threshold=threshold) == want
        assert (72, 1) in {w[:2] for w in want}


def test_the_stage_takes_out_most_of_an_item(spark, tmp_path):
    import corpus_pipeline as cp

    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, [(1, " ".join(prose(500, 60).split()[:58])), (2, prose(9, 40))])
    assert [r.doc_id for r in cp.without_benchmark(spark, docs, str(tmp_path)).collect()] == [2]


def test_query_and_sql_find_short_documents_and_items(spark, tmp_path):
    """On rows made for it, as the tables have next to none of them."""
    import __spark_entry__ as registry

    from ..oracle import assert_same, duckdb_on

    item = prose(500, 60).split()
    texts = [(k, " ".join(item[: 60 - k])) for k in range(16)]
    texts += [(20, "so one two three"), (21, "two three"), (22, prose(9, 40)), (23, ""), (24, None), (25, "one two three four"), (26, prose(501, 18))]
    documents(spark, texts).coalesce(1).write.parquet(f"{tmp_path}/documents")
    items = spark.createDataFrame([i for i in ITEMS if i[0] != 6], "item_id long, text string")
    items.coalesce(1).write.parquet(f"{tmp_path}/benchmark")
    for table in ("documents", "benchmark"):
        next((tmp_path / table).glob("*.parquet")).rename(tmp_path / f"{table}.parquet")
    found = registry.queries()["op2_decontaminate"](spark, str(tmp_path))
    assert assert_same(found, duckdb_on(tmp_path), registry.oracle_sql()["op2_decontaminate"]) > 12
    assert {r.doc_id for r in found.collect()} >= {0, 2, 6, 20, 25}
