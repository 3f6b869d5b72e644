"""Registered queries that no SQL covers, against plain Python over the same tables; what stands without other parts."""

import math
import re
import shutil
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
from pyspark.ml.feature import StopWordsRemover

from callsift.functions.scalar import PATTERNS
from callsift.plans.catalogue import CLOSINGS, QUERIES

ROOT = Path(__file__).resolve().parents[1]


def luhn(value):
    digits = [int(c) for c in value if c.isdigit()][::-1]
    return 13 <= len(digits) <= 19 and (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def test_cards_and_phones(spark, sf):
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        for kind in ("CREDIT_CARD", "PHONE_NUMBER", "US_SSN"):
            values = [m[0] for m in re.finditer(PATTERNS[kind], r.text or "", re.ASCII)]
            want |= {(r.doc_id, kind, n, v) for n, v in enumerate(v for v in values if kind != "CREDIT_CARD" or luhn(v))}
    assert {tuple(r) for r in QUERIES["q9_cards_and_phones"](spark, sf).collect()} == want and want


def test_topic_terms(spark, sf):
    stops = set(StopWordsRemover.loadDefaultStopWords("english"))
    counts, seen = defaultdict(Counter), defaultdict(set)
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = [w for w in re.findall(r"\b\w\w+\b", (r.text or "").lower()) if w not in stops]
        for t in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            counts[r.source][t] += 1
            seen[t].add(r.doc_id)
    total = Counter()
    for c in counts.values():
        total.update({t: n for t, n in c.items() if len(seen[t]) > 1})
    sizes = {s: sum(n for t, n in c.items() if len(seen[t]) > 1) for s, c in counts.items()}
    mean = sum(sizes.values()) / len(sizes)
    weight = lambda s, t: math.sqrt(counts[s][t] / sizes[s]) * math.log1p(mean / total[t])
    got = defaultdict(dict)
    for r in QUERIES["q19_topic_terms"](spark, sf).collect():
        got[r.topic_id][r.rank] = r.term
    assert set(got) == set(counts)
    for s, terms in got.items():
        best = sorted((weight(s, t) for t in counts[s] if len(seen[t]) > 1), reverse=True)[:5]
        assert np.allclose([weight(s, terms[k + 1]) for k in range(len(best))], best)


def test_segments(spark, sf):
    from callsift.providers.offline import HashEmbedder

    embedder, calls = HashEmbedder(), defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        calls[r.conv_id].append((r.turn, r.role, r.text or ""))
    want = set()
    for i, rows in calls.items():
        rows.sort()
        vectors = embedder.embed([t for _, _, t in rows]).astype(np.float64)
        cut, held = [], []
        for k, (_, role, text) in enumerate(rows):
            line = f"{role}: {text}"
            shift = bool(held) and float(vectors[k - 1] @ vectors[k]) < 0.35
            if held and (shift or len("\n".join([*held, line]).split()) > 60):
                cut.append(held)
                held = []
            held = [*held, line]
        cut.append(held)
        at = 0
        for n, own in enumerate(cut):
            want.add((f"{i}:seg:{n}", str(i), n, f"{i}:{rows[at][0]}", f"{i}:{rows[at + len(own) - 1][0]}", len(own), len("\n".join(own).split())))
            at += len(own)
    assert {tuple(r) for r in QUERIES["q22_segments"](spark, sf).collect()} == want


def test_extracted_findings(spark, sf):
    from callsift.providers.offline import RuleModel

    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        found = RuleModel().ask("findings", "", (r.text or "") + "\n" + CLOSINGS[r.doc_id % len(CLOSINGS)])[0]["findings"][:3]
        kind = ("customer-support", "account-manager", "internal-discuss")[r.doc_id % 3]
        want |= {(f"{r.doc_id}:finding:{n}", str(r.doc_id), kind, f["finding_type"], f["target"], f["value"]) for n, f in enumerate(found)}
    assert {tuple(r) for r in QUERIES["q23_extracted_findings"](spark, sf).collect()} == want and want


def test_whole_run(spark, sf):
    rows = {r.chart_point_id: r for r in QUERIES["q20_run_metrics"](spark, sf).collect()}
    members = {r.chart_point_id: r for r in QUERIES["q21_run_contributors"](spark, sf).collect()}
    assert rows and {k: r.numerator for k, r in rows.items()} == {k: r.members for k, r in members.items()}
    assert {r.metric_type for r in rows.values()} >= {"topic_prevalence_monthly", "topic_prevalence_all_time"}
    assert all(r.distinct_transcripts == members[k].transcripts and abs(r.value - r.numerator / r.denominator) < 1e-9 for k, r in rows.items())


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    """The folders go, with or without the pipeline at the top."""
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q1_prevalence_monthly' in q and not [n for n in q if n.startswith('op') or n == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    for pipeline in (True, False):
        tree = tmp_path / str(pipeline)
        shutil.copytree(ROOT, tree, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "llm"))
        if not pipeline:
            (tree / "corpus_pipeline.py").unlink(missing_ok=True)
        subprocess.run([sys.executable, "-c", code], cwd=tree, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tree), "HOME": str(tmp_path)})
    modules = [p for p in (ROOT / "callsift").rglob("*.py") if "llm" not in p.parts]
    assert not [p for p in modules if "callsift.llm" in p.read_text()]
