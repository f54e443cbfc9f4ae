"""Base places and diagonal labels against plain Python."""

import re

import pytest

from agentlake.llm import entries, licenses
from agentlake.llm.rows import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def base(text):
    w = words(text)
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), {label for _, label in places}


def spans(text):
    """{(label, template): covered} by voting over diagonals."""
    w, k, out = words(text), licenses.GRAM, {}
    for label, many in licenses.TEMPLATES.items():
        for n, wording in enumerate(many):
            t = words(wording)
            hits = {}
            for i in range(len(w) - k + 1):
                for j in range(len(t) - k + 1):
                    if w[i : i + k] == t[j : j + k]:
                        hits.setdefault(i - j, set()).add(j)
            group, last = set(), None
            for d in [*sorted(hits), None]:
                if d is None or last is not None and d - last > licenses.SLACK:
                    covered = len(group) / (len(t) - k + 1)
                    if covered >= licenses.COVERED:
                        out[label, n] = max(covered, out.get((label, n), 0))
                    group = set()
                if d is not None:
                    group |= hits[d]
                    last = d
    return out


def check(rows, texts):
    for r in rows:
        n, places, first, last, labels = base(texts[r.doc_id])
        found = spans(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (n, places, first, last, ",".join(sorted(labels)))
        assert r.labels == ",".join(sorted(labels | {label for label, _ in found}))
        assert r.score == pytest.approx(1.0 if places else max(found.values(), default=0.0))


def test_query(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    rows = entries.QUERIES["op9_license_diagonals"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)


def test_changed_and_odd_texts(spark):
    mit = licenses.TEMPLATES["mit"][3].split()
    texts = {
        1: None, 2: "", 3: "cc", 4: "a KCC by x CC-BY İ all  rights\nreserved Éa cc by", 5: " ".join(mit), 6: " ".join(mit[:60]),
        7: " ".join([*mit[:40], "new words put in here", *mit[42:], "x " * 30, *mit]), 8: "w " * 50_000 + "Licensed under CC BY-NC 4.0.",
        9: "CC BY general public license all rights reserved " * 30,
    }
    docs = spark.createDataFrame([(k, t, "x") for k, t in texts.items()] * 2 + [(None, texts[5], "x")], "doc_id long, text string, label string")
    rows = licenses.scan(docs, "doc_id").collect()
    assert len(rows) == 2 * len(texts) + 1
    check(rows, texts | {None: texts[5]})
    assert licenses.scan(docs.limit(0), "doc_id").count() == 0


def test_creative_commons_wordings_are_told_apart(spark):
    cc = {label: licenses.TEMPLATES[label][1] for label in ("cc-by", "cc-by-nc", "cc-by-nd", "cc-by-sa")}
    mit = licenses.TEMPLATES["mit"][3]
    texts = {label: f"Some words in front. {text} And some behind." for label, text in cc.items()}
    texts["cc-by,cc-by-nc"] = f"{cc['cc-by-nc']} {cc['cc-by']}"
    texts["cc-by-nc,cc-by-sa"] = cc["cc-by-nc"].replace("noncommercial", "NonCommercial-ShareAlike")
    texts["cc-by-nd,mit"] = f"{mit[:300]} {cc['cc-by-nd']} {mit[300:]}"
    # neither the older version of a wording nor a word put in takes its label away
    texts["cc-by "] = cc["cc-by"].replace("4.0 international", "3.0 unported")
    texts["cc-by-nc "] = cc["cc-by-nc"].replace("4.0", "Public License 4.0")
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r.doc_id: r.labels for r in licenses.scan(docs, "doc_id").collect()}
    assert got == {name: name.strip() for name in texts}


def test_no_python_in_the_plan(spark, sf):
    plan = entries.QUERIES["op9_license_diagonals"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
