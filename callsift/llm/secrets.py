"""Secret scans: fixed patterns plus character Markov models.

Three patterns give the base spans: assignments to a secret-like name, cloud access
keys, long hexadecimal runs. Further spans come from two character Markov models of
order two, one trained on random strings, one on ordinary identifiers and long words; a
token of 16 or more characters, whatever they are, is a secret if the log-likelihood ratio of the two favours the random model by a margin.
Both are trained here from a labelled sample that a seed fixes (``labelled_samples``).

The models are a few hundred kilobytes, travel with the task, and each text is read
once where it lies: no shuffle. Edge cases: null and empty texts have no spans; spans
are code points with exclusive ends; rows are never joined, so null and repeated
identifiers and repeated rows need no care; very long texts are searched whole; an empty
table has no rows; further columns are never read, and redaction keeps them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callsift.llm._arrow import map_texts
from callsift.shipping import ship

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "random")

#: A text without any of these (in lower case) has no assignment.
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Every access key, hexadecimal run and random token lies inside such a run.
LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Nats per character by which the random model must win.
MARGIN = 1.5
#: Weight of the next lower order, in observations.
SMOOTHING = 12.0

SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
)
FIELDS = T.StructType([T.StructField("found", T.ArrayType(SPAN))])

# Parts of ordinary identifiers.
PARTS = (
    "account action address admin api audit auto balance batch block branch buffer build button byte cache call card change "
    "check class client cloud code column commit config content copy country customer data date debug default deploy device "
    "domain draft edit element email engine entry error event export factory field file filter final folder format from "
    "gateway general get global grant graph grid group guard handler hash header height hidden history home host icon image "
    "index info input item job join journal json keep kernel key kind label last layer left level library limit line list "
    "load local lock log loop mail main map mask match max memory menu message method min mode model module month move name "
    "native network next node note number object offset open option order origin output owner package page parent path "
    "pattern payload percent pixel point policy pool port post prefix price process profile proxy public push quality query "
    "queue quick quota random range rate read record region remote report request response result return role root row rule"
).split() + (
    "run sample save scale scope script search second select server service session set shape sign site size sort source "
    "space stack start state status step stop store stream string style sum switch sync system table tag target task team "
    "temp test text theme thread time title total trace track tree trigger type unit update upload url usage user utility "
    "valid value vector vendor version video view visible volume wait walk warning watch web week weight widget width window "
    "word work worker wrap write year yield zero zone zoom"
).split()
# Ordinary words of several languages, whose compounds are long words of letters alone.
WORDS = (
    "the that this with from have which their there would about other these than then when what into only other "
    "nation station question education information international responsibility understanding nevertheless "
    "characteristic administration communication development environment transportation representation "
    "der die das und ist ein eine einen nicht auch auf aus bei mit von vor zu zum zur werden wird haben sich sein "
    "freiheit sicherheit gesundheit wahrheit krankheit schwierigkeit geschwindigkeit wirklichkeit tatigkeit moglichkeit "
    "verantwortung versicherung verpflichtung entscheidung entwicklung gesellschaft wissenschaft wirtschaft schlieslich "
    "menschlich schriftlich naturlich verschieden zwischen deutsch geschichte nachricht ansicht schutz gesetz platz "
    "erscheinung austausch beziehung untersuchung anwendung rechnung bezug gebaude ergebnis verstandnis achtung "
    "le la les des une dans pour que qui est sont avec plus mais aux eux elle elles queue oiseaux nouveaux animaux "
    "heureux heureuse ailleurs lieu mieux journaux question maison raison traduction developpement gouvernement "
    "appartement etablissement immediatement evidemment aujourdhui quelquefois feuille bouteille jeunesse richesse "
    "el los las del una uno con por para como pero esta este estos todo cuando donde porque quedo pasado cuidado "
    "ciudad universidad posibilidad nacion cancion corazon comentario documento momento trabajador gobierno "
    "pequeno desarrollo conocimiento establecimiento responsabilidad afortunadamente generalmente quiere dinero"
).split()


def labelled_samples(seed: int = 5, n: int = 9000, parts_of: list[str] = PARTS) -> tuple[list[str], list[str]]:
    """``(random strings, ordinary identifiers)``, the labelled sample the models learn from."""
    rng = np.random.default_rng(seed)
    alphabets = ("0123456789abcdef", "0123456789ABCDEF", ALPHABET[:62], ALPHABET[:62] + "+/", "abcdefghijklmnopqrstuvwxyz0123456789", ALPHABET[:62] + "_-", ALPHABET[:52], ALPHABET[:26], ALPHABET[26:52])
    noise = ["".join(rng.choice(list(alphabets[i % len(alphabets)]), int(rng.integers(16, 65)))) for i in range(n)]
    plain = []
    for i in range(n):
        parts = [parts_of[j] for j in rng.integers(0, len(parts_of), int(rng.integers(2, 7)))]
        number = str(rng.integers(0, 10 ** int(rng.integers(1, 9))))
        style = i % 10
        if style == 0:
            word = "_".join(parts) + number
        elif style == 1:
            word = parts[0] + "".join(p.title() for p in parts[1:]) + number * (i % 4 == 1)
        elif style == 2:
            word = "-".join([*parts, number])
        elif style == 3:
            word = "/".join(["", *parts]) + "/" + number
        elif style == 4:
            word = "_".join(parts).upper() + "_" + number
        elif style == 5:
            word = "".join(parts) + "=" + number
        elif style == 9:  # ruled lines, table borders, one character over and over
            n_signs, mark = int(rng.integers(2, 21)), str(rng.choice(list(ALPHABET[62:] if i % 20 < 10 else ALPHABET)))
            word = ("+" + "-" * n_signs) * 3 + "+" if i % 40 < 10 else mark * (16 + n_signs)
        else:
            word = "".join(WORDS[j] for j in rng.integers(0, len(WORDS), int(rng.integers(3, 7))))
            word = (word, word.capitalize(), word.upper())[style - 6]
        plain.append(word)
    return noise, plain


def fit_order_two(samples: list[str]) -> np.ndarray:
    """``log p(character | two before it)``; index 0 of each context axis is the start.

    Each order is smoothed towards the next lower one, down to uniform.
    """
    n = len(ALPHABET)
    code = {c: i + 1 for i, c in enumerate(ALPHABET)}
    counts = np.zeros((n + 1, n + 1, n))
    for s in samples:
        k = np.fromiter((code[c] for c in s), np.int64, len(s))
        before = np.concatenate(([0, 0], k))
        np.add.at(counts, (before[:-2], before[1:-1], k - 1), 1)
    lower = np.full(n, 1 / n)
    for table in (counts.sum((0, 1)), counts.sum(0), counts):
        lower = (table + SMOOTHING * lower) / (table.sum(-1, keepdims=True) + SMOOTHING)
    return np.log(lower)


def fit_ratio(seed: int = 5) -> np.ndarray:
    """Log-likelihood ratio of each character in context, random over ordinary."""
    noise, plain = labelled_samples(seed)
    return (fit_order_two(noise) - fit_order_two(plain)).astype(np.float32)


def log_ratio(token: str, ratio: np.ndarray, code: dict[str, int]) -> float:
    k = np.fromiter((code[c] for c in token), np.int64, len(token))
    before = np.concatenate(([0, 0], k))
    return float(ratio[before[:-2], before[1:-1], k - 1].sum())


def spans_of(text: str, ratio: np.ndarray, code: dict[str, int], margin: float = MARGIN) -> list[tuple[str, int, int]]:
    """All spans of one text by start, then kind."""
    found: list[tuple[int, int, int]] = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(name in low for name in NAMES):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    for run in LONG.finditer(text):
        token, at = run[0], run.start()
        if "AKIA" in token:
            found += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(token) if m.end() - m.start() >= LEAST["access"]]
        if len(token) >= LEAST["hex"]:
            found += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(token) if m.end() - m.start() >= LEAST["hex"]]
        if log_ratio(token, ratio, code) > margin * len(token) and not any(s <= at and run.end() <= e for s, _, e in found):
            found.append((at, 3, run.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def _finder(seed: int, margin: float):
    def make():
        ratio, code = fit_ratio(seed), {c: i + 1 for i, c in enumerate(ALPHABET)}
        return lambda text: spans_of(text, ratio, code, margin)

    return make


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 5, margin: float = MARGIN
) -> DataFrame:
    """``id_col, found``: the spans of each text, ``array<struct<kind, start, end>>``."""
    finder = _finder(seed, margin)

    def make():
        find = finder()
        return lambda texts: {
            "found": [[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in texts]
        }

    return map_texts(docs, make, FIELDS, id_col, text_col)


def blank(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """``text`` with each maximal run of overlapping spans replaced by ``mark``."""
    out, end = [], 0
    start = None
    for _, s, e in spans:
        if start is not None and s <= stop:
            stop = max(stop, e)
            continue
        if start is not None:
            out += [text[end:start], mark]
            end = stop
        start, stop = s, e
    if start is not None:
        out += [text[end:start], mark]
        end = stop
    out.append(text[end:])
    return "".join(out)


def redact_secrets(
    docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", seed: int = 5, margin: float = MARGIN
) -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; null texts stay null."""
    ship(docs.sparkSession)
    finder = _finder(seed, margin)
    held: list = []

    @F.arrow_udf(T.StringType())
    def clean(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(finder())
        out = []
        for t in texts:
            value = t.as_py()
            spans = held[0](value) if value else []
            out.append(blank(value, spans, mark) if spans else value)
        return pa.array(out, pa.string())

    return docs.withColumn(text_col, clean(F.col(text_col).cast("string")))
