import random
import re
from collections import Counter, defaultdict

from isotherm.llm import phrases

DDL = "doc_id long, text string, lang string"


def brute_force(rows, least=10, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").encode().lower()
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(rb"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = {}
    for lang, f in counts.items():
        found = []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in candidates.items() if len(p) == 2):
                continue
            best = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-best[0], -a, b" ".join(p), a, f[p[: best[1]]], f[p[best[1] :]]))
        for rank, (s, _, phrase, a, left, right) in enumerate(sorted(found)[:top], 1):
            out[lang, rank] = (phrase.decode(), a, left, right, totals[lang], -s)
    return out


def mined(spark, rows, **options):
    found = phrases.collocations(spark.createDataFrame(rows, DDL), **options).collect()
    out = {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in found}
    assert len(out) == len(found)
    return out


def random_texts(seed, n, most):
    pick = random.Random(seed)
    words = ["a", "B", "the", "of", "Ünd", "x'y", "is\x01", "new york", "New York City", "\t", "end.", "so,", "\n", "q!q", "ö\x0b", "日本"]
    return ["".join(pick.choice(words) + pick.choice([" ", " ", "  ", "\t"]) for _ in range(pick.randrange(most))) for _ in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_WORDS", 5)
    monkeypatch.setattr(phrases, "TOKENS", 50)
    texts = random_texts(1, 60, 120)
    rows = [(i, t, ("en", "de", None, "")[i % 4]) for i, t in enumerate(texts)]
    rows += rows[:20] + [(None, texts[0], "en")] * 12 + [(1, None, "en"), (2, "", "fr")]
    assert mined(spark, rows) == brute_force(rows)
    assert mined(spark, rows, least=3, top=7) == brute_force(rows, 3, 7)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PART_BYTES", 40)
    rows = [(i, t, "en") for i, t in enumerate(random_texts(2, 12, 400))]
    rows += [(90, "w" * 500 + " tail of " * 30, "en"), (91, "same " * 300, "en"), (92, "x" * 300, "en")]
    assert mined(spark, rows) == brute_force(rows)


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_CELLS", 64)
    rows = [(i, t, "en") for i, t in enumerate(random_texts(3, 40, 100))]
    assert mined(spark, rows) == brute_force(rows)


def test_scores_are_exact(spark):
    pick = random.Random(4)
    rows = [(a, pick.randrange(a, 10**16), pick.randrange(a, 10**16)) for a in (pick.randrange(10, 10 ** pick.randrange(2, 17)) for _ in range(300))]
    rows += [(10**16 - 1, 10**16 - 1, 10**16 - 1)]
    found = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", phrases.score().alias("s")).collect()
    assert all(x["s"] == 10**6 * x["a"] ** 2 // (x["l"] * x["r"]) for x in found)


def test_empty_table_and_clashing_columns(spark):
    assert mined(spark, []) == {}
    assert mined(spark, [(1, None, None), (2, "...", "en")]) == {}
    rows = [(i, t, "en") for i, t in enumerate(random_texts(5, 30, 90))]
    extra = "chunk own freq words phrase f a l r n score rank cut k cell bits".split()
    docs = spark.createDataFrame(rows, DDL).selectExpr("*", *(f"'x' AS {name}" for name in extra))
    found = phrases.collocations(docs).collect()
    assert {(r["lang"], r["rank"]): r["phrase"] for r in found} == {k: v[0] for k, v in brute_force(rows).items()}
