"""License scan against plain Python: every rule at every place, all pairs of detections; named texts."""

import re

import pytest

from retentia.llm import op13_licenses as scan

DOC = "doc_id long, text string, labels string, score int, __w string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = {
    "Released under the MIT License.": ("mit", 1, "mit"),
    "Licensed under the Apache License, Version 2.0.": ("apache-2", 1, "apache-2"),
    "Licensed under CC BY-NC 4.0.": ("cc-by-nc", 1, "cc-by-nc,cc-by-nc-4"),
    "This work is licensed under the GNU General Public License, version 3.": ("", 0, "gpl-3"),
    "GNU Lesser General Public Licence v2.1 or later": ("", 0, "lgpl-2.1"),
    "SPDX-License-Identifier: MPL 2.0": ("", 0, "mpl-2"),
    "SPDX-License-Identifier: BSD-3-Clause": ("", 0, "bsd-3-clause"),
    "Creative Commons Attribution-ShareAlike 4.0 International License": ("", 0, "cc-by-sa-4"),
    "See the Mozilla Public License 1.1 and the mozilla public license": ("", 0, "mpl,mpl-1.1"),
    "the new BSD license": ("", 0, "bsd-3-clause"),
    "Alle Rechte vorbehalten.": ("", 0, "all-rights-reserved"),
    "under the mit license under the MIT-license, cc by nc": ("cc-by-nc,mit", 3, "cc-by-nc,mit"),
    "mit Lizenz, mit Recht": ("", 0, ""),
    "apache license version 2": ("apache-2", 1, "apache-2"),
    "under the mit licence": ("", 0, "mit"),
    "": ("", 0, ""),
}
ODD = [None, " .,-", "cc", "license " * 300, "Licensed under CC BY-NC 4.0.\n" * 200, "GNU " * 50 + "GNU GPL v2 only", "under THE mit LICENSE @ mit license", "É" * 50 + " gpl 3"]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, rules):
    w = words(text)
    have = set(w) | ({"license"} if "licence" in w else set())
    found = []
    for place, r in enumerate(rules):
        if not set(r.needs) <= have:
            continue
        for i, word in enumerate(w):
            if word == r.anchor:
                low = max(i - scan.BEFORE, 0)
                near = " " + " ".join(w[low:i]) + (" " if i else "") + "@" + " ".join(w[i : i + scan.AFTER]) + " "
                m = re.search(r.pattern, near)
                if m:
                    before, after = m.group().split("@")
                    found.append((i - before.count(" ") + 1, i + after.count(" ") - 1, r.priority, place, r.label))
    base = [d for d in found if d[2] == 0]
    named = [d for d in found if d[2] > 0]

    def drops(e, d):
        within = e[0] <= d[0] and e[1] >= d[1] and e[2] >= d[2] and (e[:2] != d[:2] or e[2] > d[2] or e[3] < d[3])
        return within or (e[2] > d[2] and e[0] <= d[1] and e[1] >= d[0])

    kept = [d for d in named if not any(drops(e, d) for e in named if e is not d)]
    starts = [d[0] for d in base]
    return (
        len(w), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({d[4] for d in base})),
        ",".join(sorted({d[4] for d in base + kept})), max((scan.WEIGHTS[d[2]] for d in base + kept), default=0.0), len(kept),
    )


@pytest.fixture(scope="module")
def rows(spark):
    texts = [*TEXTS, *ODD]
    return texts, spark.createDataFrame([(i, t, "l", 1, "w") for i, t in enumerate(texts)] + [(None, texts[0], None, None, None)], DOC)


def test_against_all_pairs(rows):
    texts, docs = rows
    got = {r["doc_id"]: tuple(r)[1:] for r in scan.licenses(docs).collect()}
    assert got.pop(None) == got[0]
    assert got == {i: brute(t, scan.RULES) for i, t in enumerate(texts)}


def test_labels(rows):
    texts, docs = rows
    got = {texts[r["doc_id"]]: (r["base_labels"], r["n_base"], r["labels"]) for r in scan.licenses(docs.where("doc_id IS NOT NULL")).collect()}
    assert {t: got[t] for t in TEXTS} == TEXTS


def test_rules():
    assert len(scan.RULES) > 300 and len(set(scan.RULES)) == len(scan.RULES)
    for r in scan.RULES:
        re.compile(r.pattern)
        assert r.anchor in r.needs


def test_detections_keep_their_words(spark):
    docs = spark.createDataFrame([(1, "a b licensed under the GNU GPL v3 or later c")], "doc_id long, text string")
    row = scan.scan(docs).first()
    assert [(d["first"], d["last"], d["label"]) for d in row["__detections"]] == [(2, 9, "gpl-3")]


def test_empty_table_and_plan(spark, rows):
    _, docs = rows
    assert scan.licenses(docs.limit(0)).collect() == []
    plan = scan.licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
