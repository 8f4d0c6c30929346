"""Against every window, hot anchors or not."""

from __future__ import annotations

import pytest

from coursetide.llm import substrings

from .data import awkward, documents, prose


def plain(rows):
    first, split = {}, [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        if i is not None:
            for p in range(len(words) - 49):
                window = tuple(words[p : p + 50])
                first[window] = min(first.get(window, i), i)
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - 49):
            if i is not None and first[tuple(words[p : p + 50])] < i:
                gone[p : p + 50] = [True] * 50
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((str(i), len(words), sum(gone), b" ".join(kept).decode()))
    return sorted(out)


def removed(docs):
    kept = substrings.without_repeats(docs, substrings.repeated(docs)).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in kept)


@pytest.mark.parametrize("hot", [1, 3, 500])
def test_equals_every_window(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "AT_ONCE", 300)
    passage, other = prose(100, 70), prose(101, 51)
    rows = [(i, t if t is None else t[:4000]) for i, t in awkward()]
    rows += [(20 + k, f"{prose(k, 30)} {passage} {prose(200 + k, 40 * (k % 3))}") for k in range(12)]
    rows += [(40, f"{other} {passage} {other}"), (41, f"x {other} y"), (42, prose(100, 49)), (43, prose(100, 50))]
    rows += [(44, f"{prose(300, 60)} {prose(300, 60)}"), (44, f"{prose(300, 60)} more"), (19, f"{other} z")]
    rows += [(60 + k, prose(400, 90)) for k in range(6)] + [(70, "a " * 200), (71, "a " * 120)]
    docs = documents(spark, rows, clash=True)
    assert removed(docs) == plain(rows)


def test_paths_tell_their_source(spark):
    passage = prose(7, 60)
    docs = documents(spark, [(1, f"u v {passage} w"), (2, f"{prose(8, 20)} {passage}")])
    [path] = substrings.repeated(docs).collect()
    assert (path.doc_id, path.start, path.windows, path.source_id, path.source_start) == (2, 20, 11, 1, 2)


def test_no_rows(spark):
    docs = documents(spark, [])
    assert removed(docs) == []
