"""Benchmark decontamination against a word-by-word search."""

import random
import re

import pytest

from orderlake.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window):
    found = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[i:i + window]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(x) for x in found}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in found:
                    hit.update(range(s, s + n))
                    ids |= found[tuple(w[s:s + n])]
        out.append((i, len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(map(str, out))


@pytest.fixture
def case(odd_texts):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "Straße"]) for _ in range(n)))
             for i, n in enumerate([1, 2, 3, 5, 12, 13, 14, 30, 60])]
    items += [(None, "only nullid words here"), (20, None), (21, ""), (22, "..."), (7, items[7][1]), (23, items[7][1])]
    docs = list(odd_texts)
    for j, (i, t) in enumerate(items):
        docs.append((100 + j, f"before it {t or ''} and after"))
        docs.append((200 + j, (t or "").upper() + "!"))
        docs.append((300 + j, " ".join((t or "").split()[2:18])))
    docs.append((400, " x ".join([items[7][1]] * 3) + " pad" * 500))
    docs.append((401, items[8][1] + " pad" * 3000))
    return docs, items


@pytest.mark.parametrize("block_chars", [10**6, 300])
def test_hits_equal_plain_search(spark, make_docs, case, block_chars):
    docs, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontam.contamination(make_docs(docs), bench, window=13, block_chars=block_chars)
    got = [str((r["doc_id"], r["hits"]["n_words"], r["hits"]["n_hit"], r["hits"]["items"], r["c"]))
           for r in out.withColumn("c", decontam.is_contaminated("hits")).collect()]
    assert sorted(got) == plain(docs, items, 13)


def test_filter_keeps_columns_and_clean_rows(spark, make_docs, case):
    docs, items = case
    table = make_docs(docs).withColumnRenamed("score", "_hits")
    kept = decontam.drop_contaminated(table, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == table.columns
    want = [x for x in plain(docs, items, 13) if x.endswith("False)")]
    assert kept.count() == len(want)


def test_empty_tables(spark, make_docs, odd_texts):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.drop_contaminated(make_docs(odd_texts), none).count() == len(odd_texts)
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontam.contamination(make_docs([]), some).count() == 0


def test_a_text_that_a_third_of_the_items_share(spark, make_docs, monkeypatch):
    hot = " ".join(f"hot{i}" for i in range(15))
    items = [(i, hot if i % 3 == 0 else f"own{i} words here") for i in range(300)] + [(None, hot), (3, hot)]
    docs = [(i, f"before {hot} after") for i in range(40)] + [(50, f"own1 words here {hot}"), (51, "clean text"), (52, None)]
    seen = []
    real = decontam.Windows.__init__
    monkeypatch.setattr(decontam.Windows, "__init__", lambda self, texts, window: seen.append(texts) or real(self, texts, window))
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = make_docs(docs).withColumnRenamed("score", "_items")
    out = decontam.contamination(table, bench, block_chars=10**6)
    assert out.columns == [*table.columns, "hits"]
    got = [str((r["doc_id"], r["hits"]["n_words"], r["hits"]["n_hit"], r["hits"]["items"], r["c"]))
           for r in out.withColumn("c", decontam.is_contaminated("hits")).collect()]
    assert sorted(got) == plain(docs, items, 13)
    assert [len(x) for x in seen] == [201]                      # the hot text is collected and broadcast once


def test_repeated_rows_and_clashing_names(spark, make_docs):
    docs = [(1, "alpha beta gamma")] * 3 + [(None, "alpha beta gamma"), (2, "none of it")]
    bench = spark.createDataFrame([(7, "alpha beta gamma"), (8, "ALPHA beta gamma")], "item_id long, text string")
    table = make_docs(docs).withColumnRenamed("score", "_part0")
    out = decontam.contamination(table, bench)
    assert sorted(str((r["doc_id"], r["hits"]["items"])) for r in out.collect()) == sorted(
        str((i, ["7", "8"] if "alpha" in t else [])) for i, t in docs)
