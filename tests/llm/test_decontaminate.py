"""Window hits against plain Python, on edge cases; removal of documents and spans."""

import hashlib
import re

from retentia.llm import op4_decontaminate as deco

DOC = "doc_id long, text string, w int, at string, len string, item_id long"
ITEM = "item_id long, text string, hash int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, t, *_ in items:
        w = words(t)
        n = min(10, len(w))
        if n and i is not None:
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t, *_ in docs:
        w, hit, named = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    hit |= set(range(k, k + n))
                    named |= found
        text = ",".join(sorted(map(str, named)))
        out.append((d, len(w), len(hit), len(named), hashlib.sha256(text.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


LONG = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, LONG, 0), (12, "short item", 0), (3, "Über ÉTÉ x1", 0), (4, None, 0), (5, " .,", 0), (None, "ghost words here", 0), (2, "eleven twelve", None), (1, LONG, 0), (30, "SHORT, item!", 1)]
DOCS = [
    (1, "say: " + LONG.upper() + "!", 1, "a", "b", 9), (2, "one two three four five six seven eight nine TEN only", 1, "a", "b", 9), (3, None, None, None, None, None), (4, "", 1, "", "", 1),
    (5, "-- ?? --", 1, "", "", 1), (6, "a short-item, short item", 1, "", "", 1), (7, "Über été x1 und Über ÉTÉ x1", 1, "", "", 1), (None, "short item", 1, "", "", 1), (None, "clean text", 1, "", "", 1),
    (8, "short", 1, "", "", 1), (8, "a short item", 1, "", "", 1), (9, "ghost words here", 1, "", "", 1), (10, (LONG + " ") * 900, 1, "", "", 1), (11, "x\x00short\titem", 1, "", "", 1), (6, "a short-item, short item", 1, "a", "b", 9),
]


def test_hits(spark):
    docs, items = spark.createDataFrame(DOCS, DOC), spark.createDataFrame(ITEMS, ITEM)
    assert sorted((tuple(r) for r in deco.decontaminate(docs, items).collect()), key=str) == brute(DOCS, ITEMS)


def test_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(deco, "MAX_BROADCAST_WINDOWS", 0)
    test_hits(spark)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS, DOC), spark.createDataFrame(ITEMS, ITEM)
    assert deco.decontaminate(docs.limit(0), items).collect() == []
    assert sorted((tuple(r) for r in deco.decontaminate(docs, items.limit(0)).collect()), key=str) == brute(DOCS, [])


def test_removal(spark):
    docs, items = spark.createDataFrame(DOCS, DOC), spark.createDataFrame(ITEMS, ITEM)
    clean = [d for d in DOCS if not brute([d], ITEMS)[0][5]]
    kept = deco.remove_documents(docs, items)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == sorted(clean, key=str)
    cut = deco.remove_spans(docs, items)
    texts = {(r["doc_id"], r["text"]) for r in cut.collect()}
    assert cut.columns == docs.columns and cut.count() == len(DOCS)
    assert (1, "say: ") in texts and (7, "Über été x1 und ") in texts and (6, "a ") in texts and (2, "only") in texts and (3, None) in texts and (5, "-- ?? --") in texts


def test_no_python_in_the_plan(spark):
    docs, items = spark.createDataFrame(DOCS, DOC), spark.createDataFrame(ITEMS, ITEM)
    plan = deco.decontaminate(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
