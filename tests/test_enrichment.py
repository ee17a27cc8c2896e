from __future__ import annotations

import re
import string

import pytest
from pyspark.sql import functions as F

from echolot.config import LABEL_VOCABULARY, rules_from_vocabulary
from echolot.functions.terms import INLINE_TERM_LIMIT
from echolot.operators import enrichment
from echolot.operators.scoring import scored

LEXICON = {"gut": 1, "schlecht": -2}
RULES = [("EU", "europa"), ("Daten", "daten"), ("Datenschutz", "daten"), ("EU", "union")]
TEXTS = {
    1: "Gut, sehr gut!",
    2: "schlecht GUT schlecht",
    3: "nichts davon; gutes",
    4: "",
    5: None,
    6: "Die Europa-Union und ihre DATEN, Daten",
}


@pytest.fixture
def texts(spark):
    rows = [(iid, f"title {iid}", text) for iid, text in TEXTS.items()]
    return spark.createDataFrame(rows, "iid long, title string, desc_clean string")


def words(text):
    return re.findall(r"[^\W\d_]+", text.lower())


def brute_sentiment(text, lexicon):
    if text is None:
        return None
    weights = [lexicon[w] for w in words(text) if w in lexicon]
    return max(-1.0, min(1.0, sum(weights) / len(weights))) if weights else 0.0


def brute_labels(text, rules):
    present = set(words(text or ""))
    return sorted({label for label, word in rules if word in present})


def values(df, name):
    return {row.iid: row[name] for row in df.collect()}


def padding(n):
    """Words that occur in no text."""
    letters = string.ascii_lowercase
    return ["q" + letters[i // 676] + letters[i // 26 % 26] + letters[i % 26] for i in range(n)]


@pytest.mark.parametrize("form", ["inline", "join", "frame"])
def test_sentiment_in_all_forms(spark, texts, form):
    lexicon = dict(LEXICON)
    if form == "join":
        lexicon.update(dict.fromkeys(padding(INLINE_TERM_LIMIT), 1))
    given = lexicon
    if form == "frame":
        given = spark.createDataFrame(list(lexicon.items()), "tok string, w int")
    scores = enrichment.add_sentiment_scores(texts, given)
    assert scores.columns == ["iid", "title", "desc_clean", "sentiment"]
    assert values(scores, "sentiment") == {
        iid: brute_sentiment(text, LEXICON) for iid, text in TEXTS.items()
    }


@pytest.mark.parametrize("form", ["inline", "join", "frame"])
def test_labels_in_all_forms(spark, texts, form):
    rules = list(RULES)
    if form == "join":
        rules += [("Plattform", word) for word in padding(INLINE_TERM_LIMIT)]
    given = rules
    if form == "frame":
        given = spark.createDataFrame(rules, "label string, tok string")
    labelled = enrichment.add_labels(texts, given)
    assert values(labelled, "labels_v1") == {
        iid: brute_labels(text, RULES) for iid, text in TEXTS.items()
    }


def test_versions_of_an_issue_do_not_mix_in_the_join_form(spark):
    rows = [(1, "gut"), (1, "schlecht"), (2, "gut"), (2, "gut")]
    df = spark.createDataFrame(rows, "iid long, desc_clean string")
    lexicon = spark.createDataFrame([("gut", 1), ("schlecht", -1)], "tok string, w int")
    got = enrichment.add_sentiment_scores(df, lexicon).collect()
    assert sorted((r.iid, r.desc_clean, r.sentiment) for r in got) == [
        (1, "gut", 1.0), (1, "schlecht", -1.0), (2, "gut", 1.0), (2, "gut", 1.0),
    ]


def test_large_term_tables_are_not_broadcast(spark, texts):
    terms = spark.createDataFrame([(w, 1) for w in padding(50)], "tok string, w int")
    hinted = enrichment.broadcast_if_small(terms)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    for limits in ({"max_rows": 49}, {"max_bytes": 10}):
        plain = enrichment.broadcast_if_small(terms, **limits)
        assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()


def test_empty_rule_tables(texts):
    assert set(values(enrichment.add_sentiment_scores(texts, {}), "sentiment").values()) == {0.0, None}
    assert set(map(tuple, values(enrichment.add_labels(texts, []), "labels_v1").values())) == {()}


def test_enrich_equals_the_single_enrichers(texts):
    from echolot.config import IngestConfig

    cfg = IngestConfig(lexicon=LEXICON, label_rules=tuple(RULES))
    whole = enrichment.enrich(texts, cfg)
    assert values(whole, "sentiment") == values(
        enrichment.add_sentiment_scores(texts, LEXICON), "sentiment"
    )
    assert values(whole, "labels_v1") == values(enrichment.add_labels(texts, RULES), "labels_v1")
    assert set(values(whole, "org").values()) == {"Unklar"}


def test_organisation_comes_from_title_or_text(spark):
    rows = [
        (1, "Beitrag der Beispiel GmbH", "von der Anderen AG"),
        (2, None, "im Namen des Bündnis e.V. geschrieben"),
        (3, "ohne", "die gmbh"),
        (4, None, None),
    ]
    df = spark.createDataFrame(rows, "iid long, title string, desc_clean string")
    got = values(enrichment.add_organization_attribution(df), "org")
    assert got == {1: "Beispiel GmbH", 2: "Bündnis e.V.", 3: "Unklar", 4: "Unklar"}


@pytest.mark.parametrize(
    ("text", "org"),
    [
        ("Konsultationsbeitrag der nordlicht GmbH", "nordlicht GmbH"),
        ("Unsere AGB gelten", "Unklar"),
        ("Diese SERVICES", "Unklar"),
        ("für die Muster Digital Services GmbH.", "Muster Digital Services GmbH"),
        ("von Müller & Söhne GmbH", "Müller & Söhne GmbH"),
        ("T-Systems International GmbH", "T-Systems International GmbH"),
        ("Die 1&1 AG meint", "1&1 AG"),
        ("Erste GmbH Zweite GmbH", "Erste GmbH"),
        ("wir als gmbh, eine kleine GmbH", "Unklar"),
    ],
)
def test_organisation_names(spark, text, org):
    df = spark.createDataFrame([(1, None, text)], "iid long, title string, desc_clean string")
    assert values(enrichment.add_organization_attribution(df), "org") == {1: org}


def test_prompts(spark):
    df = spark.createDataFrame([(1, None, "Text")], "iid long, title string, desc_clean string")
    row = enrichment.build_prompts(df, ["EU", "Daten"], "Ordne.", "Nenne.").first()
    assert row.label_prompt == "Ordne.\n\n\nLabels:\nEU, Daten\n\nIssue:\nText\n"
    assert row.org_prompt == "Nenne.\n\n\nTitel:\nNone\n\nInhalt:\nText\n"


def test_pending_and_assemble(spark, texts):
    done = spark.createDataFrame([(1,), (2,), (2,)], "iid long")
    assert sorted(values(enrichment.pending(texts, done), "iid")) == [3, 4, 5, 6]
    scores = spark.createDataFrame([(1, 0.5), (9, 1.0)], "iid long, sentiment double")
    orgs = spark.createDataFrame([(2, "A")], "iid long, org string")
    whole = enrichment.assemble(texts, scores, orgs)
    assert {r.iid: (r.sentiment, r.org) for r in whole.collect()} == {
        1: (0.5, None), 2: (None, "A"), 3: (None, None), 4: (None, None), 5: (None, None),
        6: (None, None),
    }
    assert enrichment.assemble(texts).count() == len(TEXTS)


def test_scorer_isolates_bad_rows_and_skips_null(texts):
    def make():
        def score(rows):
            if any(text == "" for (text,) in rows):
                raise ValueError("empty")
            return [float(len(text)) for (text,) in rows]

        return score

    value = scored(
        "desc_clean", make_scorer=make, returns="double", default=0.0, skip_null=True, batch_rows=3
    )
    got = values(texts.withColumn("s", value), "s")
    assert got == {
        iid: None if text is None else float(len(text)) for iid, text in TEXTS.items()
    }


def test_scorer_returns_lists_and_checks_their_number(texts):
    def make():
        return lambda rows: [["EU"]] if len(rows) == 1 and rows[0][0] == 1 else []

    value = scored(
        F.col("iid"), make_scorer=make, returns="array<string>", default=[], batch_rows=4
    )
    got = values(texts.withColumn("l", value), "l")
    assert got == {1: ["EU"], 2: [], 3: [], 4: [], 5: [], 6: []}


def test_short_and_long_term_tables_agree(spark):
    """Null keys, null texts and large weights, looked up in the row and joined."""
    rows = [(None, "gut gut"), (1, "gut schlecht gut"), (2, None), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "iid long, desc_clean string")
    short = {"gut": 2_000_000_000, "schlecht": -1}
    letters = string.ascii_lowercase
    long = short | {f"x{a}{b}": 1 for a in letters for b in letters} | {f"y{a}{b}": 1 for a in letters for b in letters}
    assert len(short) <= INLINE_TERM_LIMIT < len(long)

    def found(lexicon):
        scored = enrichment.add_sentiment_scores(df, lexicon)
        both = enrichment.add_labels(scored, [(word, word) for word in lexicon])
        return sorted(map(str, both.select("iid", "desc_clean", "sentiment", "labels_v1").collect()))

    assert found(short) == found(long)


def test_term_tables_are_checked(spark, texts):
    for term in ("Gut", "zwei  worte", "zwei Worte", "7"):
        terms = spark.createDataFrame([(term, 1)], "tok string, w int")
        with pytest.raises(Exception, match="lower-case words with one space"):
            enrichment.add_sentiment_scores(texts, terms).collect()


def test_every_label_of_the_vocabulary_can_be_given(spark):
    rules = rules_from_vocabulary(LABEL_VOCABULARY)
    assert [label for label, _ in rules] == list(LABEL_VOCABULARY)
    df = spark.createDataFrame([(1, "!\n".join(LABEL_VOCABULARY))], "iid long, desc_clean string")
    assert enrichment.add_labels(df, rules).first().labels_v1 == sorted(LABEL_VOCABULARY)


def test_phrases_by_lookup_and_by_join(spark):
    rows = [(1, "low\n code, low code"), (2, "open source code"), (3, None), (4, ""), (1, "source")]
    df = spark.createDataFrame(rows, "iid long, desc_clean string")
    rules = [("A", "low code"), ("B", "open source"), ("C", "source code"), ("D", "code low code"), ("E", "source")]
    table = spark.createDataFrame(rules, "label string, tok string")
    weights = {"low code": 2, "code": -1, "source code": 4}
    lexicon = spark.createDataFrame(list(weights.items()), "tok string, w int")

    def found(rules, lexicon):
        both = enrichment.add_sentiment_scores(enrichment.add_labels(df, rules), lexicon)
        return sorted(map(str, both.select("iid", "desc_clean", "labels_v1", "sentiment").collect()))

    assert found(rules, weights) == found(table, lexicon)
    labels = {r.desc_clean: r.labels_v1 for r in enrichment.add_labels(df, table).collect()}
    assert labels["low\n code, low code"] == ["A", "D"]
    assert labels["open source code"] == ["B", "C", "E"]
    scores = {r.desc_clean: r.sentiment for r in enrichment.add_sentiment_scores(df, lexicon).collect()}
    assert scores == {"low\n code, low code": 0.5, "open source code": 1.0, None: None, "": 0.0, "source": 0.0}


def test_term_table_is_measured_in_all_its_columns(spark):
    long_label = spark.createDataFrame([("x" * 1000, "wort")], "label string, tok string")

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert hinted(enrichment.broadcast_if_small(long_label))
    assert not hinted(enrichment.broadcast_if_small(long_label, max_bytes=500))
    assert not hinted(enrichment.broadcast_if_small(long_label, max_rows=0))
