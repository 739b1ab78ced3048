"""The interpolated model against one of dictionaries."""

import collections
import math
import os
import random
import re
import zlib

import pytest

from samekin.llm import language_model as lm

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
DOCS = "doc_id long, text string, batch long, ids string, score string, held_out string"


def tokens_of(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lower), None]


def expected(rows, order, steps=lm.STEPS):
    """id, held out, tokens, known, training tokens, base, score by plain counting."""
    parts = [zlib.crc32(str("" if i is None else i).encode()) % 7 for i, _ in rows]
    texts = [tokens_of(t) for _, t in rows]

    def history(tokens, i, n):
        return tuple(([0] * n + tokens)[i + n - n : i + n])

    def count(chosen):
        grams = [collections.Counter() for _ in range(order + 1)]
        seen = [collections.Counter() for _ in range(order + 1)]
        for tokens, part in zip(texts, parts):
            if part in chosen:
                for i, token in enumerate(tokens):
                    for n in range(1, order + 1):
                        context = history(tokens, i, n - 1)
                        grams[n][context, token] += 1
                        seen[n][context] += 1
        return grams, seen

    training = set(range(7)) - {2}
    full, kept = count(training), count(training - {3})
    words = len(full[0][1])

    def estimates(model, tokens, i):
        grams, seen = model
        found, bucket = [1.0 / (words + 1)], 0
        for n in range(1, order + 1):
            context = history(tokens, i, n - 1)
            total = seen[n][context]
            found.append(grams[n][context, tokens[i]] / total if total else 0.0)
            if n > 1 and total:
                bucket = (n - 1) * lm.POWERS + int(math.log2(total))
        return found, bucket

    weights = [[1 / (b // lm.POWERS + 2)] * (b // lm.POWERS + 2) for b in range(order * lm.POWERS)]
    held = [estimates(kept, t, i) for t, p in zip(texts, parts) if p == 3 for i in range(len(t))]
    last = -math.inf
    known = set()
    for _ in range(steps):
        shares = collections.defaultdict(lambda: [0.0] * (order + 2))
        likelihood = 0.0
        for found, bucket in held:
            each = [w * p for w, p in zip(weights[bucket], found)]
            likelihood += math.log(sum(each))
            shares[bucket][-1] += 1
            for n, e in enumerate(each):
                shares[bucket][n] += e / sum(each)
        for bucket, s in shares.items():
            had = len(weights[bucket])
            weights[bucket] = [(x + 1) / (s[-1] + had) for x in s[:had]]
        known |= set(shares)
        if not held or likelihood - last < lm.GAIN * len(held):
            break
        last = likelihood
    for bucket in range(len(weights)):
        if bucket not in known and bucket % lm.POWERS and bucket - 1 in known:
            weights[bucket] = weights[bucket - 1]
            known.add(bucket)
    total = sum(full[0][1].values())
    result = []
    for (doc_id, _), tokens, part in zip(rows, texts, parts):
        counts = [full[0][1][(), t] for t in tokens]
        base = sum(math.log10((c + 1) / (total + words + 1)) for c in counts)
        score = 0.0
        for i in range(len(tokens)):
            found, bucket = estimates(full, tokens, i)
            mixture = sum(w * p for w, p in zip(weights[bucket], found)) if total else found[0]
            score += math.log10(mixture)
        result.append((doc_id, part == 2, len(tokens), sum(c > 0 for c in counts), total, base, score))
    return result


def check(found, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    found, want = sorted(map(tuple, found), key=order), sorted(want, key=order)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    for a, b in zip(found, want):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "a", "b", "c") for i, t in rows], DOCS)


def texts(rng, size):
    words = ["the", "The", "cat", "sat", "é", "on", "mat.", "x" * 300]
    spaces = [" ", "\n", " \t ", "\x0b"]
    return "".join(rng.choice(words[: rng.randrange(1, 9)]) + rng.choice(spaces) for _ in range(rng.randrange(size)))


@pytest.mark.parametrize("order", [1, 3])
def test_scores_equal_plain_counting(spark, order):
    rng = random.Random(order)
    rows = [(i, texts(rng, 40)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n"), (None, "the cat"), (203, "lorem ipsum " * 20_000)]
    rows += [rows[5], rows[5]]
    table = table_of(spark, rows).repartition(3)
    found = lm.language_model_scores(table, order=order, batch_bytes=2_000, grams_together=500)
    check(found.collect(), expected(rows, order))


def test_missing_parts(spark):
    assert lm.language_model_scores(table_of(spark, []).limit(0)).collect() == []
    part = {r: next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == r) for r in range(7)}
    for chosen in ([2], [3], [2, 4]):
        rows = [(part[r], "a b a") for r in chosen]
        check(lm.language_model_scores(table_of(spark, rows)).collect(), expected(rows, lm.ORDER))


@pytest.mark.skipif(not os.path.isdir(f"{TESTDATA}/sf0.001"), reason="no test tables")
def test_query_equals_plain_counting(spark):
    from samekin.llm.queries import QUERIES

    found = QUERIES["op13_language_model"](spark, f"{TESTDATA}/sf0.001").collect()
    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = expected(list(map(tuple, rows)), lm.ORDER)
    check(found, want)
    # Contexts tell more than single words: also on documents nothing was learned from.
    unseen = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
