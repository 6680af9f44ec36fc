"""Language models and fingerprints against plain Python on dicts and lists."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from duoscope.llm import language_id, order_minhash
from tests.llm.data import awkward, frame, row, sentence

MASK = (1 << 64) - 1


# ---- languages: interpolated Kneser-Ney from the formula ---------------------


def units(text):
    kept = "".join(c.lower() if c.isalpha() else " " for c in text or "").split()
    return "".join(w + " " for w in kept)


class Plain:
    def __init__(self, texts, discount=0.75):
        self.d, self.levels, letters = discount, {}, set()
        for lang, mine in texts.items():
            level = {4: Counter()}
            for t in mine:
                x = "   " + units(t)
                level[4].update(x[i - 3 : i + 1] for i in range(3, len(x)))
            for k in (3, 2, 1):
                level[k] = Counter(g[1:] for g in level[k + 1])  # how many different characters stand before
            letters |= set(level[1])
            after = {k: defaultdict(dict) for k in level}
            for k, counts in level.items():
                for g, n in counts.items():
                    after[k][g[:-1]][g[-1]] = n
            self.levels[lang] = after
        self.alphabet = len(letters) + 1

    def p(self, lang, context, c):
        after = self.levels[lang][len(context) + 1].get(context)
        lower = (lambda: self.p(lang, context[1:], c)) if context else (lambda: 1 / self.alphabet)
        if after is None:
            return lower()
        total = sum(after.values())
        left = 1 - sum(max(n - self.d, 0) for n in after.values()) / total
        return max(after.get(c, 0) - self.d, 0) / total + left * lower()

    def bits(self, lang, text):
        x = "   " + units(text)
        return -sum(math.log2(self.p(lang, x[i - 3 : i], x[i])) for i in range(3, len(x))) / (len(x) - 3)


def test_languages_equal_the_formula(spark):
    r = random.Random(6)
    letters = {"aa": "abcdeé", "bb": "defgh", "cc": "ghijkß"}
    make = lambda lang, n: " ".join("".join(r.choice(letters[lang]) for _ in range(r.randrange(1, 7))) for _ in range(n))
    texts = {lang: [make(lang, 40) for _ in range(20)] for lang in letters}
    training = [(lang, t.title() if i % 2 else t + "!?") for lang, mine in texts.items() for i, t in enumerate(mine)]
    plain = Plain({lang: [t for other, t in training if other == lang] for lang in letters})
    asked = [make(lang, n) for lang in letters for n in (1, 3, 30)] + [make("aa", 3) + " " + make("cc", 3), "zzz q", "de", "x1y2z", training[0][1]]
    asked += [t for _, t, *_ in awkward() if t and units(t)][:1]
    rows = [row(i, t) for i, t in enumerate(asked)]
    out = {x.doc_id: x for x in language_id.identify(frame(spark, rows), spark.createDataFrame(training, "lang string, text string")).collect()}
    for i, t in enumerate(asked):
        want = {lang: plain.bits(lang, t) for lang in letters}
        assert out[i].n_units == len(units(t))
        assert out[i].entropy == pytest.approx(min(want.values()), abs=2e-3)
        low, next_ = sorted(want.values())[:2]
        assert out[i].margin == pytest.approx(next_ - low, abs=4e-3)
        if next_ - low > 0.01:
            assert out[i].lang_pred == min(want, key=want.get)


def test_equally_likely_languages_give_the_first_by_name(spark):
    training = spark.createDataFrame([("bb", "same words"), ("aa", "same words")], "lang string, text string")
    out = language_id.identify(frame(spark, [row(1, "same words"), row(2, "other")]), training).collect()
    assert {x.lang_pred for x in out} == {"aa"} and all(x.margin == pytest.approx(0, abs=1e-6) for x in out)


# ---- fingerprints: Order MinHash, one tuple and k-mer at a time -----------------


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def seeds(n, seed):
    return [mix(i * 0x9E3779B97F4A7C15 + seed * 2 + 1 & MASK) for i in range(1, n + 1)]


def rank(h, seed):
    x = (h >> 32) ^ (seed >> 32)
    x = x * 0x85EBCA6B & 0xFFFFFFFF
    x ^= x >> 15
    x = x * 0xC2B2AE35 & 0xFFFFFFFF
    return x ^ x >> 16


def plain_print(text, k=5, tuples=64, per_tuple=2):
    if not text:
        return [0] * tuples
    k = min(k, len(text))
    factors = [f | 1 for f in seeds(k, 400 + k)]
    seen, hashes = Counter(), []
    for i in range(len(text) - k + 1):
        kmer = text[i : i + k]
        value = sum(mix(ord(c) + (k << 32)) * f for c, f in zip(kmer, factors)) & MASK
        hashes.append(mix(value + seen[kmer] * 0xD6E8FEB86659FD93 & MASK))
        seen[kmer] += 1
    out = []
    for seed in seeds(tuples, 64):
        least = sorted(range(len(hashes)), key=lambda i: (rank(hashes[i], seed), i))[:per_tuple]
        total = sum(mix(hashes[i] ^ ((place + 1) * 0x9E3779B97F4A7C15 & MASK)) for place, i in enumerate(sorted(least))) & MASK
        out.append(max(mix(total) >> 48, 1))
    return out


def plain_likeness(a, b):
    pairs = [(x, y) for x, y in zip(a, b) if x or y]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 1.0


def test_fingerprints_and_likeness_equal_plain_python(spark, tmp_path):
    rows = [row(i, t) for i, t in enumerate([None, "", "a", "abab" * 40, "é漢😀" * 7, sentence(1, 90), sentence(2, 90), sentence(1, 89) + " end", "aaaaaaaaaaaaaaaaaaaaaaaa"])]
    rows += [row(8, "aaaaaaaaaaaaaaaaaaaaaaaa"), row(None, sentence(3, 20))]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = order_minhash.op4_order_minhash(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    # Descending ids, null ones last; rows 8 are equal, so their order does not show.
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    hexed = lambda p: "".join(f"{v:04x}" for v in p)
    want = []
    for i, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = plain_print(text), plain_print(edited), plain_print(after)
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b), round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)))
    got = [(x.doc_id, x.n_chars, x.edited_sha256, x.fingerprint, x.edited_fingerprint, round(x.near_edited, 9), round(x.near_next, 9)) for x in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
