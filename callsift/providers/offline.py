"""Deterministic offline providers. They keep the pipeline running; they are no match for real models."""

from __future__ import annotations

import re
from typing import Any

import numpy as np

from callsift.providers.calls import Usage

# Words that speak for a kind of call, a finding, a polarity.
CALL_WORDS = {
    "customer-support": ("ticket", "issue", "error", "bug", "outage", "fix", "broken", "help", "support"),
    "account-manager": ("renewal", "contract", "pricing", "quarter", "roadmap", "account", "expansion", "license"),
    "internal-discuss": ("standup", "sprint", "we should", "our team", "roadblock", "backlog", "internal", "hiring"),
}
FINDING_WORDS = {
    "renewal_risk": ("cancel", "churn", "renewal"), "feature_request": ("wish", "feature", "would like"),
    "resolution": ("resolved", "fixed", "solved"), "process_friction": ("slow", "waiting", "manual"),
    "competitive_risk": ("competitor", "alternative"), "commitment": ("will send", "by friday", "i will"),
    "opportunity": ("expand", "upgrade", "interested"), "objection": ("too expensive", "concern"),
    "operational_risk": ("incident", "outage"), "delivery_risk": ("delay", "slip"), "capacity_constraint": ("capacity", "overloaded"),
}
GOOD = ("great", "thanks", "happy", "love", "excellent", "perfect")
BAD = ("bad", "angry", "frustrated", "problem", "unhappy", "terrible")


class HashEmbedder:
    """Hashed counts of one- and two-word runs, signed, of unit length."""

    name = "offline-hash-v1"

    def __init__(self, size: int = 256):
        self.size = size

    def embed(self, texts: list[str]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        out = np.zeros((len(texts), self.size), np.float32)
        for row, text in zip(out, texts):
            words = re.findall(r"\w+", (text or "").lower())
            for gram in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
                h = xxh64_intdigest(gram)
                row[h % self.size] += 1.0 if h >> 63 else -1.0
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def tokens(self, text: str) -> int:
        return len(text.split())


class RuleModel:
    """Keyword rules behind the language-model interface."""

    name = "offline-rules-v1"

    def ask(self, task: str, instructions: str, prompt: str) -> tuple[dict[str, Any] | None, Usage]:
        low = prompt.lower()
        usage = Usage(len(instructions.split()) + len(prompt.split()), 20)
        if task == "classify":
            hits = {k: sum(low.count(w) for w in ws) for k, ws in CALL_WORDS.items()}
            best = max(hits, key=lambda k: hits[k])
            total = sum(hits.values())
            share = hits[best] / total if total else 0.0
            return {"source_set": best, "confidence": round(0.5 + share / 2, 4), "rationale": f"{hits[best]} of {total} keywords"}, usage
        if task == "label":
            terms = re.findall(r"'([^']+)'", prompt.split("\n")[1]) if "\n" in prompt else []
            name = " / ".join(terms[:3]) or "unnamed topic"
            return {"label": name, "description": f"Segments about {', '.join(terms) or 'no common terms'}."}, usage
        found = []
        up, down = sum(low.count(w) for w in GOOD), sum(low.count(w) for w in BAD)
        tone = "positive" if up > down else "negative" if down > up else "neutral"
        if up or down:
            found.append({"finding_type": "sentiment", "target": "product", "value": tone, "reason": f"{up} good, {down} bad words"})
        for kind, words in FINDING_WORDS.items():
            hit = next((w for w in words if w in low), None)
            if hit:
                found.append({"finding_type": kind, "target": "product", "value": tone, "reason": f"mentions '{hit}'"})
        return {"findings": found}, usage


class DictionaryDetector:
    """Names from a list, as persons; an organisation or product is preserved."""

    def __init__(self, persons: tuple[str, ...] = (), preserved: tuple[str, ...] = ()):
        self.terms = [(p, "PERSON", "redact") for p in persons] + [(p, "ORGANIZATION", "preserve") for p in preserved]

    def detect(self, text: str) -> list[dict[str, Any]]:
        return [
            {"start": m.start(), "end": m.end(), "entity_type": kind, "value": m[0], "score": 0.85, "detector": "dictionary", "action": action}
            for term, kind, action in self.terms
            for m in re.finditer(rf"\b{re.escape(term)}\b", text)
        ]
