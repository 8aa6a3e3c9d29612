"""Threats in four languages, and the composed machine against a plain run of the five parts."""

import itertools

import pytest

from wakeline.llm import toxicity as tox

PLAIN = tox.Grammar(tox.Model().lexicon)
W, N, R = tox.THREAT_WEIGHT, tox.NEGATION_FACTOR, tox.REPORT_FACTOR


@pytest.mark.parametrize("text, score", [
    ("i will kill you", W), ("ich werde dich töten", W), ("je vais te tuer", W), ("te voy a matar", W), ("ich töten dich", W), ("voy a golpear te", W),
    ("i will not kill you", W * N), ("he said he will kill you", W * R), ("he said he will not kill you", W * R * N),
    ("ich werde dich nicht töten", W * N), ("je ne vais pas te tuer", W * N), ("nunca te matar", W * N), ("dijo te voy a matar", W * R),
    ("kill the lights", 0.0), ("you will kill it", 0.0), ("te", 0.0), ("dich", 0.0), ("they beat the drum", 0.0), ("te a b c matar", 0.0),
    ("kill you idiot", W + tox.INSULT_WEIGHT * tox.TARGET_FACTOR),
])
def test_threats(text, score):
    assert PLAIN.clause(text) == pytest.approx(score)


def plain(symbols, weight=1.0):
    """The clause score by looking back and ahead from each token."""
    total, last, seen_target, open_insult, softer = 0.0, 0.0, False, False, 1.0
    left = 0  # tokens in which a verb waits for a target
    behind = 0  # tokens in which an object waits for a verb
    negated, reported = 0, False
    for s in symbols:
        low = (tox.NEGATION_FACTOR if negated and s in ("insult", "threat") else 1.0) * (tox.REPORT_FACTOR if reported and s in ("insult", "threat") else 1.0)
        if s == "threat":
            softer = low
        if s == "insult":
            gain = weight * low * (tox.TARGET_FACTOR if seen_target else 1.0)
            total, last = total + gain, gain
            open_insult = open_insult or not seen_target
        if s in ("target", "object"):
            if open_insult and not seen_target:
                total += (tox.TARGET_FACTOR - 1) * last
            seen_target = True
        # Threats: behind a verb a target, or behind an object a verb.
        if left:
            if s == "threat":
                left = tox.THREAT_SCOPE
            else:
                if s in ("target", "object"):
                    total += tox.THREAT_WEIGHT * softer
                left -= 1
        elif behind:
            if s == "threat":
                total, behind = total + tox.THREAT_WEIGHT * softer, 0
            else:
                behind = tox.THREAT_SCOPE if s == "object" else behind - 1
        elif s == "threat":
            left = tox.THREAT_SCOPE
        elif s == "object":
            behind = tox.THREAT_SCOPE
        negated = tox.NEGATION_SCOPE if s == "negation" else max(0, negated - 1)
        reported = reported or s == "report"
    return total


WORDS = {"insult": "idiot", "threat": "kill", "target": "you", "object": "dich", "negation": "not", "report": "said", "other": "tree"}


def test_the_product_equals_its_parts():
    for size in (1, 2, 3, 4, 5):
        for symbols in itertools.product(tox.SYMBOLS, repeat=size):
            want = plain(symbols, tox.INSULT_WEIGHT)
            assert PLAIN.clause(" ".join(WORDS[s] for s in symbols)) == pytest.approx(want), symbols
