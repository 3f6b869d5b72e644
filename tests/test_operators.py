"""Operators on literal rows; the cases are those of FIXTURES.md."""

import json
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from callsift.functions import scalar
from callsift.operators import charts, findings, metrics, privacy, segments, spans, topics, turns, vectors
from callsift.operators.classify import classification_counts, classify, confidence_reviews
from callsift.providers.calls import Usage, with_retries
from callsift.providers.offline import DictionaryDetector, HashEmbedder, RuleModel
from callsift.schemas import SCHEMAS, checked, conform
from callsift.settings import Settings

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests
S = Settings()


def one(text, speakers=("Jordan Smith",), accounts=S.account_patterns, others=()):
    return privacy.redact_transcript(list(speakers), [text] * len(speakers), privacy.PatternDetector(accounts), [*others, privacy.TermDetector(S.allowlist)])


# --- personal data --------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("mine is 123-45-6789 ok", [("PHONE_NUMBER", "123-45-6789", True)]),
        ("host 192.168.10.12 is up", [("PHONE_NUMBER", "192.168.10.12", True)]),
        ("at 2026-02-21 11:30 then", [("PHONE_NUMBER", "2026-02-21 11", False)]),
        ("the customer identity portal", [("ACCOUNT_ID", "entity", False)]),
        ("see Support Case #6977", []),
        ("mail A.b@Example.org now", [("EMAIL_ADDRESS", "A.b@Example.org", False)]),
        ("card 4111 1111 1111 1111 there", [("CREDIT_CARD", "4111 1111 1111 1111 ", True)]),
        ("ping 10.0.0.1 now", [("IP_ADDRESS", "10.0.0.1", False)]),
        ("we use Aegis Identity here", [("ALLOWLIST", "Aegis Identity", False)]),
    ],
)
def test_detected_and_resolved(text, kinds):
    assert [(s["entity_type"], s["value"], s["conflict"]) for s in one(text)["spans"]] == kinds


def test_plus_phone_stays_and_is_flagged():
    found = one("call +1 415 555 0199 today")
    assert "+1 415 555 0199" in found["sentences"][0] and found["review_required"]
    assert found["residual_findings"][0]["value"] == privacy.MASK


def test_invalid_card_is_no_card():
    assert not privacy.luhn("4111111111111112") and privacy.luhn("4111111111111111") and not privacy.luhn("411")


def test_allowlist_beats_names_and_patterns_beat_the_allowlist():
    names = DictionaryDetector(persons=("Aegis Identity",))
    assert [s["action"] for s in one("we use Aegis Identity", others=[names])["spans"]] == ["preserve"]
    found = privacy.resolve_spans([privacy._span(0, 14, "ALLOWLIST", "x", "allowlist", "preserve"), privacy._span(2, 5, "IP_ADDRESS", "y", "regex:IP_ADDRESS")])
    assert found[0]["entity_type"] == "IP_ADDRESS" and found[0]["conflict"]


def test_speakers_share_tokens():
    found = one("Jordan and jordan smith", speakers=("Jordan Smith", "Jordan"))
    assert found["speakers"] == ["[PERSON_01]", "[PERSON_01]"]
    assert found["sentences"][0] == "[PERSON_01] and [PERSON_01]"
    found = one("Jordan spoke", speakers=("Jordan Smith", "Jordan Brown"))
    assert found["speakers"] == ["[PERSON_01]", "[PERSON_02]"] and found["sentences"][0] == "Jordan spoke"


def test_report_counts():
    found = one("write a@b.co or c@d.co, again a@b.co")
    assert dict(found["category_counts"]) == {"EMAIL_ADDRESS": 3}
    assert found["replacement_count"] == 4 and found["unique_replacement_count"] == 5  # speaker, two parts, two addresses
    assert found["sentences"][0] == "write [EMAIL_ADDRESS_01] or [EMAIL_ADDRESS_02], again [EMAIL_ADDRESS_01]"
    assert not found["review_required"]


@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 10), st.sampled_from(["regex:X", "dictionary"]), st.sampled_from(["redact", "preserve"])), max_size=12))
@settings(max_examples=150, deadline=None)
def test_resolved_spans_never_overlap(raw):
    found = privacy.resolve_spans([privacy._span(a, a + n, "X", "v", d, act) for a, n, d, act in raw])
    assert all(x["end"] <= y["start"] for x, y in zip(found, found[1:]))


def test_resolution_in_sql_equals_the_fold(spark):
    rng = np.random.default_rng(3)
    rows, want = [], []
    for k in range(30):
        group = []
        for o in range(8):
            a, n = int(rng.integers(0, 30)), int(rng.integers(1, 9))
            s = privacy._span(a, a + n, str(rng.choice(["A", "B"])), "v", str(rng.choice(["regex:A", "names"])), str(rng.choice(["redact", "preserve"])), float(rng.choice([0.5, 1.0])))
            group.append(s)
            rows.append((k, a, a + n, s["entity_type"], s["detector"], s["action"], s["score"], o))
        want += [(k, s["start"], s["end"], s["conflict"]) for s in privacy.resolve_spans(group)]
    df = spark.createDataFrame(rows, "k int, start int, end int, entity_type string, detector string, action string, score double, ordinal int")
    got = [(r.k, r.start, r.end, r.conflict) for r in spans.resolve(df, "k").collect()]
    assert sorted(got) == sorted(want)


def test_overlap_groups_and_containment(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 3, 8), (1, 8, 9)], "k int, start int, end int")
    assert [r.grp for r in spans.overlap_groups(df, "k").orderBy("start").collect()] == [1, 1, 2]
    ranges = spark.createDataFrame([(1, 2, 8)], "k int, start int, end int")
    assert {(r.start, r.end) for r in spans.not_contained(df, ranges, "k").collect()} == {(0, 5), (8, 9)}


def test_alias_fold(spark):
    df = spark.createDataFrame([("Ann Lee met ann, not Anna, at A.B", [("Ann Lee", "[P_01]"), ("Ann", "[P_02]"), ("A.B", "$x")])], "t string, a array<struct<surface:string,token:string>>")
    assert df.select(scalar.replace_aliases(F.col("t"), F.col("a")).alias("x")).first().x == "[P_01] met [P_02], not Anna, at $x"


def test_redact_tables(spark):
    rows = [("t1", 1, 7, "Bo Li", "thanks Bo", 1.0, None), ("t1", 0, 7, "Bo Li", "mail x@y.org", 0.0, None), ("t2", 0, 1, "Cy", None, None, None)]
    df = spark.createDataFrame(rows, SCHEMAS["utterances"])
    found = privacy.redact(df, S).persist()
    lines = {(r.transcript_id, r["index"]): (r.speaker_name, r.sentence) for r in privacy.redacted_utterances(found).collect()}
    assert lines == {("t1", 0): ("[PERSON_01]", "mail [EMAIL_ADDRESS_01]"), ("t1", 1): ("[PERSON_01]", "thanks [PERSON_01]"), ("t2", 0): ("[PERSON_01]", "")}
    assert {(r.transcript_id, r.placeholder, r.surface) for r in privacy.mappings(found).collect()} == {("t1", "[PERSON_01]", "Bo Li"), ("t1", "[EMAIL_ADDRESS_01]", "x@y.org"), ("t2", "[PERSON_01]", "Cy")}
    assert privacy.reports(found).count() == 2 and privacy.privacy_reviews(found).count() == 0


# --- turns, segments, vectors ---------------------------------------------------------------


def test_unclassified_transcript_raises(spark):
    df = spark.createDataFrame([("t", 0, 0, "a", "b", None, None)], SCHEMAS["redacted_utterances"])
    none = spark.createDataFrame([], SCHEMAS["classifications"])
    with pytest.raises(Exception, match="unclassified transcript"):
        turns.materialize_turns(df, none).collect()


@pytest.mark.parametrize(
    ("tokens", "shifts", "want"),
    [([900], [False], [0]), ([900, 1], [False, False], [0, 1]), ([2, 2, 2], [False, False, True], [0, 0, 1]), ([300, 200, 1], [False] * 3, [0, 0, 1]), ([], [], [])],
)
def test_cuts(tokens, shifts, want):
    assert segments.cuts(tokens, shifts, 500) == want


@given(st.lists(st.tuples(st.integers(0, 300), st.booleans()), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_segments_partition_turns_in_order(rows):
    found = segments.cuts([n for n, _ in rows], [s for _, s in rows], 500)
    assert found[0] == 0 and all(b - a in (0, 1) for a, b in zip(found, found[1:]))
    for g in set(found):
        own = [n for (n, _), x in zip(rows, found) if x == g]
        assert sum(own) <= 500 or len(own) == 1 or sum(own[:-1]) == 0


def test_shift_is_strict(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0]), (1, 1, [0.25, 0.5]), (1, 2, [1.0, 0.0])], "k int, o int, embedding array<double>")
    rows = vectors.neighbour_similarity(df, "k", "o", 0.25).orderBy("o").collect()
    assert [r.shift for r in rows] == [False, False, False]
    assert [r.shift for r in vectors.neighbour_similarity(df, "k", "o", 0.2500001).orderBy("o").collect()] == [False, True, True]


def test_create_segments(spark):
    rows = [("t:0", "t", "customer-support", 0, "A", "hello there", None, None), ("t:1", "t", "customer-support", 1, "B", "hello there", None, None), ("t:2", "t", "customer-support", 2, "A", "zebra quantum", None, None)]
    out = segments.create_segments(spark.createDataFrame(rows, SCHEMAS["turns"]), HashEmbedder(), S).orderBy("order").collect()
    assert [(r.segment_id, r.turn_ids, r.speakers, r.text, r.token_count) for r in out] == [
        ("t:seg:0", ["t:0", "t:1"], ["A", "B"], "A: hello there\nB: hello there", 6), ("t:seg:1", ["t:2"], ["A"], "A: zebra quantum", 3),
    ]


# --- classification and findings ------------------------------------------------------------


class Fixed:
    name = "fixed"

    def __init__(self, answers):
        self.answers = answers

    def ask(self, task, instructions, prompt):
        return self.answers[task], Usage(1, 2)


def test_confidence_threshold_is_strict(spark):
    df = spark.createDataFrame([("t", i, 0, "a", f"line {i}", None, None) for i in range(3)], SCHEMAS["redacted_utterances"])
    for confidence, low in ((0.7, False), (0.69, True)):
        model = Fixed({"classify": {"source_set": "account-manager", "confidence": confidence, "rationale": "r"}})
        out = classify(df, model, S)
        assert out.first().low_confidence is low
        assert [r.reason for r in confidence_reviews(out, 0.7).collect()] == (["confidence 0.69 below 0.7"] if low else [])
    assert {r.source_set: r.calls for r in classification_counts(out).collect()} == {"customer-support": 0, "account-manager": 1, "internal-discuss": 0}


def test_retries():
    calls, slept = [], []

    def ask():
        calls.append(1)
        return (None if len(calls) < 3 else {"x": 1}), Usage(1, 1)

    assert with_retries(ask, 4, 1.0, slept.append) == ({"x": 1}, Usage(3, 3)) and slept == [1.0, 2.0]
    with pytest.raises(ValueError):
        with_retries(lambda: (None, Usage()), 2, 0.0)


def test_findings_cap_and_ids(spark):
    item = lambda k: {"finding_type": k, "target": "t", "value": "positive", "reason": "r"}
    model = Fixed({"findings": {"findings": [item(k) for k in ("sentiment", "a", "b", "c")]}})
    df = spark.createDataFrame([("s", "t", "account-manager", 0, "x", "y", ["x"], ["A"], "text", 1)], SCHEMAS["segments"])
    out = findings.extract_findings(df, model, S).orderBy("finding_id").collect()
    assert [(r.finding_id, r.request_id, r.finding_type) for r in out] == [(f"s:finding:{i}", "findings:s", k) for i, k in enumerate(("sentiment", "a", "b"))]


def found(spark, rows):
    return spark.createDataFrame([(f"f{i}", s, src, k) for i, (s, src, k) in enumerate(rows)], "finding_id string, segment_id string, source_set string, finding_type string")


def test_promotion(spark):
    rows = [("a", "account-manager", "new"), ("b", "account-manager", "new"), ("b", "account-manager", "new"), ("c", "internal-discuss", "odd"), ("d", "internal-discuss", "odd"), ("e", "customer-support", "odd")]
    rows += [("x", "customer-support", "resolution"), ("y", "internal-discuss", "resolution"), ("z", "customer-support", "sentiment")]
    df = found(spark, rows)
    tally = {r.proposed_type: (r.finding_count, r.segment_count, r.promoted) for r in findings.proposals(df, 3).collect()}
    assert tally == {"new": (3, 2, False), "odd": (3, 3, True), "resolution": (1, 1, False)}
    # A customer type proposed once internally drops the customers' rows as well.
    assert sorted(r.finding_type for r in findings.keep_findings(df, 3).collect()) == ["odd", "odd", "odd", "sentiment"]


# --- topics and metrics ---------------------------------------------------------------------


def test_metadata_labels_and_outliers(spark):
    rows = [("v", "v:0", 0, f"s{i}", "t", "account-manager" if i else "customer-support", False) for i in range(3)] + [("v", "v:outlier", -1, "s9", "t", "internal-discuss", True)]
    df = spark.createDataFrame(rows, SCHEMAS["topic_assignments"])
    meta = topics.cluster_metadata(df).orderBy("cluster_id").collect()
    assert [(m.cluster_size, list(m.source_distribution.items())) for m in meta] == [(1, [("internal-discuss", 1)]), (3, [("customer-support", 1), ("account-manager", 2)])]
    assert {r.source_set: r.outliers for r in topics.outlier_counts(df).collect()}["internal-discuss"] == 1
    segs = spark.createDataFrame([(f"s{i}", "t", "customer-support", i, "x", "y", [], [], f"billing invoice {i} billing", 1) for i in range(3)], SCHEMAS["segments"])
    terms = topics.topic_terms(df, segs)
    assert [r.term for r in terms.orderBy("rank").collect()] == ["billing invoice", "invoice", "invoice billing", "billing"]
    emb = spark.createDataFrame([(f"s{i}", "t", [1.0, float(i)]) for i in range(3)], SCHEMAS["segment_embeddings"])
    near = topics.centroid_segments(df, emb, segs, 2)
    assert [r.segment_id for r in near.orderBy("rank").collect()] == ["s2", "s1"]
    label = topics.label_topics(topics.cluster_metadata(df), terms, near, segs, RuleModel(), S).collect()
    assert len(label) == 1 and label[0].centroid_segment_ids == ["s2", "s1"] and "billing" in label[0].label


def test_terms_in_one_pass(spark):
    """Repeated segments and topics that share segments; each text is cut into terms once, in no pair of term and segment."""
    rows = [("v", f"v:{t}", t, s, "t", "customer-support", False) for t, s in ((0, "s0"), (0, "s0"), (0, "s1"), (1, "s1"), (1, "s2"), (1, "s3"))]
    texts = {"s0": "billing fee", "s1": "billing login", "s2": "login outage", "s3": "login outage billing"}
    df = spark.createDataFrame(rows, SCHEMAS["topic_assignments"])
    segs = spark.createDataFrame([(s, "t", "customer-support", 0, "x", "y", [], [], x, 1) for s, x in texts.items()], SCHEMAS["segments"])
    for least in (1, 2, 3, 4):
        words = [(t, s, w) for _, _, t, s, *_ in rows for own in [texts[s].split()] for w in own + [" ".join(p) for p in zip(own, own[1:])]]
        known = [(t, w) for t, s, w in words if len({b for _, b, x in words if x == w}) >= least]
        size = {t: sum(x == t for x, _ in known) for t, _ in known}
        weight = lambda t, w: np.sqrt(known.count((t, w)) / size[t]) * np.log1p(np.mean(list(size.values())) / sum(x == w for _, x in known))  # noqa: B023, E731
        want = [(f"v:{t}", k + 1, w) for t in sorted(size) for k, w in enumerate(sorted({w for x, w in known if x == t}, key=lambda w: (-weight(t, w), w))[:5])]
        made = topics.topic_terms(df, segs, least_segments=least)
        assert [(r.topic_id, r.rank, r.term) for r in made.orderBy("topic_id", "rank").collect()] == want
    made = topics.topic_terms(df, segs)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Generate explode") == 1 and "distinct segment_id" not in plan


def test_small_scopes_have_no_topics(spark):
    segs = spark.createDataFrame([("s", "t", "customer-support", 0, "x", "y", [], [], "a", 1)], SCHEMAS["segments"])
    emb = spark.createDataFrame([("s", "t", [1.0])], SCHEMAS["segment_embeddings"])
    assert topics.assign_topics(segs, emb, None, S).count() == 0


def metric_frames(spark):
    calls = spark.createDataFrame([("t1", "2026-02-03"), ("t2", "2026-03-04")], "transcript_id string, d string").select("transcript_id", F.col("d").cast("timestamp").alias("transcript_datetime"))
    segs = spark.createDataFrame([("s1", "customer-support", "t1"), ("s2", "customer-support", "t2"), ("s3", "account-manager", "t2")], "segment_id string, source_set string, transcript_id string")
    assigned = spark.createDataFrame([("v", "v:0", 0, "s1", "t1", "customer-support", False), ("v", "v:1", 1, "s2", "t2", "customer-support", False), ("v", "v:outlier", -1, "s3", "t2", "account-manager", True)], SCHEMAS["topic_assignments"])
    labels = spark.createDataFrame([("v:0", "Billing")], "topic_id string, label string")
    rows = [("f0", "s1", "t1", "objection", "x", "positive"), ("f1", "s1", "t1", "objection", "x", "negative"), ("f2", "s2", "t2", "sentiment", "ui", "positive"), ("f3", "gone", "t2", "objection", "x", "positive")]
    fs = spark.createDataFrame(rows, "finding_id string, segment_id string, transcript_id string, finding_type string, target string, value string")
    return calls, segs, assigned, labels, fs


def test_metrics_and_contributors(spark):
    rates, rows = metrics.aggregate_metrics(*metric_frames(spark))
    got = {r.chart_point_id: (r.category, r.numerator, r.denominator, r.value, r.distinct_transcripts, r.polarity) for r in rates.collect()}
    assert got == {
        "topic_month|customer-support|2026-02|v:0": ("Billing", 1, 1, 1.0, 1, None),
        "topic_month|customer-support|2026-03|v:1": ("v:1", 1, 1, 1.0, 1, None),
        "topic_all|customer-support|v:0": ("Billing", 1, 2, 0.5, 1, None),
        "topic_all|customer-support|v:1": ("v:1", 1, 2, 0.5, 1, None),
        "finding|customer-support|2026-02|objection": ("objection", 2, 1, 2.0, 1, "neutral"),
        "sentiment|customer-support|2026-03|positive:ui": ("positive:ui", 1, 1, 1.0, 1, "positive"),
    }
    counts = {r.chart_point_id: r.n for r in rows.groupBy("chart_point_id").agg(F.count("*").alias("n")).collect()}
    assert counts == {k: v[1] for k, v in got.items()}
    assert {r.metric_type for r in checked(rates).collect()} <= {"topic_prevalence_monthly", "topic_prevalence_all_time", "sentiment_distribution", "finding_prevalence"}
    order = [r.chart_point_id.split("|")[0] for r in metrics.export_order(rates).collect()]
    assert order == ["topic_month", "topic_month", "topic_all", "topic_all", "finding", "sentiment"]


def test_unknown_transcript_raises(spark):
    calls, segs, assigned, labels, fs = metric_frames(spark)
    with pytest.raises(Exception, match="unknown transcript"):
        metrics.topic_prevalence(metrics.topic_members(assigned, calls.where("transcript_id = 't2'")), labels).collect()


def test_top_n_ties_keep_the_smaller_id(spark):
    rows = [(f"p{i}", f"p{i}", "topic_prevalence_all_time", "account-manager", "all", f"c{i}", 5, 9, 0.5, 1, None, {}) for i in range(7)]
    out = charts.chart_rows(spark.createDataFrame(rows, SCHEMAS["metrics"]), charts.CHARTS[1]).collect()
    assert sorted(r.chart_point_id for r in out) == ["p0", "p1", "p2", "p3", "p4"]


# --- charts ---------------------------------------------------------------------------------


def test_hierarchy(tmp_path):
    topic = lambda i, src, text: {"topic_id": f"v:{i}", "cluster_id": i, "label": text, "description": text, "source_distribution": {src: 3}, "cluster_size": 3}
    charts.write_hierarchy([topic(0, "account-manager", "a")], HashEmbedder(), 0.4, tmp_path)
    assert not (tmp_path / "topic_hierarchy_groups.json").exists() and not (tmp_path / "chart_manifest.json").exists()
    three = [topic(0, "account-manager", "invoice billing"), topic(1, "customer-support", "invoice billing"), topic(2, "internal-discuss", "sprint planning")]
    charts.write_hierarchy(three, HashEmbedder(), 0.4, tmp_path)
    groups = json.loads((tmp_path / "topic_hierarchy_groups.json").read_text())["groups"]
    assert [len(g["topics"]) for g in groups] == [2, 1] and groups[0]["source_sets"] == ["account-manager", "customer-support"]
    merges = charts.average_linkage(np.array([[1.0, 0], [1, 0], [0, 1]]))
    assert [(a, b, round(h, 9), n) for a, b, h, n in merges] == [(0, 1, 0.0, 2), (2, 3, 1.0, 3)]
    assert charts.branch_colours(merges, ["account-manager"] * 3)[-1] != charts.CROSS


# --- settings, schemas ----------------------------------------------------------------------


def test_settings(tmp_path):
    env = tmp_path / ".env"
    env.write_text("MAXIMUM_SEGMENT_TOKENS=200\nUNKNOWN=1\n")
    assert Settings.load(env, {}).maximum_segment_tokens == 200
    assert Settings.load(env, {"MAXIMUM_SEGMENT_TOKENS": "300"}).maximum_segment_tokens == 300
    for bad in ({"MAXIMUM_SEGMENT_TOKENS": "501"}, {"MINIMUM_CLUSTER_SIZE": "1"}, {"LLM_TIMEOUT_SECONDS": "0"}):
        with pytest.raises(ValueError):
            Settings.load(None, bad)
    assert Settings.load(None, {"ALLOWLIST": " A B, ,C "}).allowlist == ("A B", "C") and len(Settings().account_patterns) == 1


def test_schema_checks(spark):
    df = spark.createDataFrame([("t", "elsewhere", 0.5, "r", False)], SCHEMAS["classifications"])
    with pytest.raises(Exception, match="out of domain"):
        checked(df).collect()
    with pytest.raises(ValueError, match="unknown columns"):
        conform(df.withColumn("more", F.lit(1)), "classifications")


def test_scalars(spark):
    row = spark.sql("select '2026-02-03T23:30:00Z' a, '' b, ' x  y ' c").select(
        scalar.iso_timestamp(F.col("a")).cast("string").alias("a"), scalar.iso_timestamp(F.col("b")).alias("b"), scalar.word_count(F.col("c")).alias("c"),
        scalar.safe_rate(F.lit(1), F.lit(0)).alias("r"), scalar.placeholder(F.lit("PERSON"), F.lit(3)).alias("p"),
    ).first()
    assert (row.a, row.b, row.c, row.r, row.p) == ("2026-02-03 23:30:00", None, 2, 0.0, "[PERSON_03]")


def test_polarity_counts_all_that_is_not_positive_against(spark):
    rows = [("a", v) for v in ("neutral", "neutral", "positive")] + [("b", "neutral"), ("c", None), ("c", "positive"), ("d", "positive"), ("d", "positive"), ("d", "negative")]
    out = spark.createDataFrame(rows, "k string, v string").groupBy("k").agg(metrics.majority_polarity(F.col("v")).alias("p")).collect()
    assert {r.k: r.p for r in out} == {"a": "negative", "b": "negative", "c": "neutral", "d": "positive"}


def test_segments_are_cut_by_the_tokens_of_the_whole_text():
    lines = ["one two", "three", "four five six", "seven"]
    joined = lambda text: 2 * text.count("\n") + len(text.split())  # noqa: E731  a tokenizer that counts line ends, too
    assert segments.cuts_by_text(lines, [False] * 4, 5, joined) == [0, 0, 1, 2]
    assert segments.cuts_by_text(lines, [False] * 4, 100, joined) == [0, 0, 0, 0]
    assert segments.cuts_by_text(lines, [True] * 4, 100, joined) == [0, 1, 2, 3]
    assert segments.cuts_by_text(["a b c", "d"], [False] * 2, 1, joined) == [0, 1] and segments.cuts_by_text([], [], 1, joined) == []


def test_entity_detector():
    found = privacy.EntityDetector(lambda t: [(0, 3, "PERSON", 0.9), (4, 8, "ORGANIZATION", 0.5), (4, 8, "PERSON", 0.4), (9, 10, "DATE", 1.0)]).detect("Ada Acme x")
    assert [(s["value"], s["entity_type"], s["action"]) for s in found] == [("Ada", "PERSON", "redact"), ("Acme", "ORGANIZATION", "preserve")]


def test_a_call_that_takes_too_long_fails():
    import time

    from callsift.providers.calls import Usage, with_retries

    with pytest.raises(TimeoutError):
        with_retries(lambda: time.sleep(2), 2, 0.0, timeout=0.05)
    assert with_retries(lambda: ({"a": 1}, Usage(1, 2)), 1, 0.0, timeout=5)[0] == {"a": 1}


def test_clusters_without_distant_rows_have_no_outliers(spark):
    from callsift.providers.clusters import BisectingClusterer

    rng = np.random.default_rng(0)
    rows = [(f"s{i}", (rng.normal(0, 0.01, 8) + 3 * np.eye(8)[i % 2]).tolist()) for i in range(120)]
    fit = lambda more: {r.segment_id: r.cluster_id for r in BisectingClusterer().fit(spark.createDataFrame(rows + more, "segment_id string, embedding array<double>"), 5, 1).collect()}
    out = fit([])
    assert all(c >= 0 for c in out.values()) or sum(c < 0 for c in out.values()) < 6
    assert not {out[f"s{i}"] for i in range(0, 120, 2)} & {out[f"s{i}"] for i in range(1, 120, 2)} - {-1}
    assert fit([("far", [90.0] * 8)])["far"] == -1
