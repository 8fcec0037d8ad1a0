"""Operators 5 and 10 against models of dicts and loops: weights, decoding and scores must agree."""

import math
import re
from collections import Counter
from statistics import median

import numpy as np
import pyarrow as pa
import pytest

from corpusflow.llm import common as C
from corpusflow.llm import langid, toxicity

M32, M64 = (1 << 32) - 1, (1 << 64) - 1
KNOWN = [
    ("the cat sat on the mat, and the dog ran", "en"), ("where are the keys of the house?", "en"), ("A short one then", "en"),
    ("der Hund läuft über die Straße", "de"), ("die Katze schläft auf dem Sofa", "de"), ("wo ist der Schlüssel zum Haus", "de"),
    ("le chat dort sur le canapé", "fr"), ("où sont les clés de la maison ?", "fr"), ("un petit chien court ici", "fr"),
    ("el gato duerme en el sofá", "es"), ("¿dónde están las llaves de la casa?", "es"), ("un perro corre por la calle", "es"),
]
ASKED = ["the dog sat", "die Straße", "la maison", "las llaves del gato", "a", "ß", "12 , 34", "cat Katze chat gato", "漢字 and é", "the the the " * 40]


def plain_grams(text):
    """Pairs and triples that begin in the text or at the space after it."""
    raw = [b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode()] + [32] * 3
    for i in range(len(raw) - 2):
        two = raw[i] << 8 | raw[i + 1]
        yield two
        yield (((two << 8 | raw[i + 2]) * 2654435761 & M32) >> 16) + 65536


def plain_languages(rows, asked):
    """The nearest codeword and the score of each asked text, and whether it is ambiguous."""
    names = sorted({lang for _, lang in rows})
    code = [[int(x) for x in row] for row in langid.codewords(len(names))]
    seen = {n: Counter(g for t, lang in rows if lang == n for g in plain_grams(t)) for n in names}
    halves = {n: [sum(c for g, c in seen[n].items() if (g >= 65536) == half) for half in (False, True)] for n in names}
    rate = lambda n, g: (seen[n][g] + 0.1) / (halves[n][g >= 65536] + 6553.6)

    def weight(g, bit):
        sides = [[rate(n, g) for k, n in enumerate(names) if code[k][bit] == side] for side in (1, 0)]
        return math.log(sum(sides[0]) / len(sides[0])) - math.log(sum(sides[1]) / len(sides[1])) if all(sides) else 0.0

    def voices(text):
        grams = list(plain_grams(text))
        return [sum(weight(g, bit) for g in grams) / len(grams) for bit in range(len(code[0]))]

    own, tuned = [(voices(t), names.index(lang)) for t, lang in rows], []
    for bit in range(len(code[0])):
        low, high = ([v[bit] for v, k in own if code[k][bit] == side] for side in (0, 1))
        if not low or not high:
            tuned.append((0.0, 1.0, 1.0))
            continue
        middle = (median(low) + median(high)) / 2
        right = sum((v[bit] > middle) == (code[k][bit] == 1) for v, k in own) / len(own)
        tuned.append((middle, 8 / max(median(high) - median(low), 1e-6), max(2 * right - 1, 0.05)))
    trust = sum(t for _, _, t in tuned)
    for text in asked:
        z = [(v - b) * s for v, (b, s, _) in zip(voices(text), tuned, strict=True)]
        loss = [sum(math.log1p(math.exp(-x if bit else x)) * t / trust for x, bit, (_, _, t) in zip(z, word, tuned, strict=True)) for word in code]
        first, second = sorted(loss)[:2]
        yield names[loss.index(first)], 1 / sum(math.exp(-4 * (x - first)) for x in loss), second - first


@pytest.mark.parametrize("names", [("en", "de"), ("en", "de", "fr"), ("en", "de", "fr", "es")])
def test_language_as_a_plain_model_has_it(names):
    rows = [r for r in KNOWN if r[1] in names]
    model = langid.fit([t.encode() for t, _ in rows], [lang for _, lang in rows])
    best, score, unsure = langid.decode(model, *langid.padded(*C.utf8(pa.array(ASKED))))
    for k, (name, share, margin) in enumerate(plain_languages(rows, ASKED)):
        assert model.languages[best[k]] == name, ASKED[k]
        assert score[k] == pytest.approx(share, abs=1e-4) and (abs(margin - langid.MARGIN) < 1e-4 or unsure[k] == (margin < langid.MARGIN))


def plain_subwords(word):
    """Buckets of a word's n-grams of 3 to 5 bytes and of the whole word."""
    raw, keys = b"<" + word + b">", []
    for size in (3, 4, 5):
        for i in range(len(raw) - size + 1):
            key = 0
            for b in raw[i : i + size]:
                key = key * 0x100000001B3 + b + 1 & M64
            keys.append(key ^ size)
    keys.append(sum((b + 7) * (0x9E3779B97F4A7C15 * (i + 1) & M64) for i, b in enumerate(raw)) & M64)
    return [((key ^ key >> 29) * 0xBF58476D1CE4E5B9 & M64) % (1 << 64) >> 40 for key in keys]


def plain_toxicity(text, scores, bias):
    words = re.findall(rb'[^ \t\n\x0b\x0c\r.,;:!?|"()\[\]{}<>]+', text.encode().lower())
    value = [float(np.mean([scores[b % toxicity.BUCKETS] for b in plain_subwords(w)])) for w in words]
    pieces = max(1, -(-len(words) // 8))
    cuts = [i * len(words) // pieces for i in range(pieces + 1)]
    worst = max(sum(value[a:b]) / max(b - a, 1) + bias for a, b in zip(cuts, cuts[1:]))
    return 1 / (1 + math.exp(-worst))


def test_toxicity_as_a_plain_model_has_it():
    rows = [(f"you are a {w} and a {v}", 1) for w in ("grumblefink", "snortwick") for v in ("mudlump", "fool")]
    rows += [(f"the {w} of the {v} is fine", 0) for w in ("house", "garden") for v in ("town", "river")]
    model = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    asked = [t for t, _ in rows] + ["", " .,;", "x", "GRUMBLEF1NK!", "mudlumps, mudlump; (fool) [snortwick]", "ünïcode 漢字   it's", "the house " * 30 + "grumblefink " * 5 + "of the town " * 21]
    got = toxicity.score_batch(model, pa.array([*asked, None]))
    assert model.trained and got[-1] == got[len(rows)]
    assert list(got[:-1]) == pytest.approx([plain_toxicity(t, model.scores, model.bias) for t in asked], abs=1e-9)
    assert min(got[:4]) > 0.5 > max(got[4:8])
