"""Phrases of a term table against texts: values, and no more joined rows than series of tokens."""

from __future__ import annotations

from echolot.operators import enrichment

TEXTS = ["the the the of", "The, of!", "of", "", None, " a of the b ", "the of the of"]
TERMS = ["the", "the of", "of the b", "the the", "", "a of the b", *(f"the {c}{d}" for c in "xyz" for d in "uvw")]


def _brute(text, term):
    words = enrichment.re.split(r"[^a-z]+", text.lower())
    size = term.count(" ") + 1
    return sum(" ".join(words[i : i + size]) == term for i in range(len(words) - size + 1))


def frames(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "iid long, desc_clean string")
    return df, spark.createDataFrame([(term, term) for term in TERMS], "label string, tok string")


def test_occurrences_and_labels_by_brute_force(spark):
    df, rules = frames(spark)
    found = enrichment._matched_terms(df, rules, "desc_clean", "iid").groupBy("iid", "tok").count().collect()
    want = {(i, w): _brute(t, w) for i, t in enumerate(TEXTS) if t is not None for w in TERMS}
    assert {(r.iid, r.tok): r["count"] for r in found} == {pair: n for pair, n in want.items() if n}
    labels = {r.iid: r.labels_v1 for r in enrichment.add_labels(df, rules).collect()}
    assert labels == {i: sorted(w for w in TERMS if t is not None and want[i, w]) for i, t in enumerate(TEXTS)}


def test_a_text_gives_one_row_for_each_different_series(spark):
    df, rules = frames(spark)
    matched = enrichment._matched_terms(df, rules, "desc_clean", "iid", distinct=True)
    assert matched.groupBy("iid", "tok").count().where("count > 1").isEmpty()
    plan = matched._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith" not in plan and "startswith" not in plan.lower()
    assert "(tok#" in plan  # joined on the whole series
