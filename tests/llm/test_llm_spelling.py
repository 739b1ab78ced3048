"""Spelling variants against a plain neighbourhood search."""

import collections
import os
import random
import re
import zlib

import pytest

from samekin.llm.spelling import spelling_variants

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
DOCS = "doc_id long, text string, word string, n long, size int, key string, _rows long"


def expected(rows, every=199, least_length=6, least_count=5, times=5):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    near = collections.defaultdict(set)
    shorter, holes = collections.defaultdict(set), collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1 :]].add(w)
            holes[w[:i], w[i + 1 :]].add(w)
    for w in words:
        for longer in shorter.get(w, ()):
            near[w].add(longer)
            near[longer].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= times * n:
            form[w] = best
    found = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        found.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return found


def result(table, **options):
    return [tuple(r) for r in spelling_variants(table, **options).collect()]


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, 2, "k", 3) for i, t in rows], DOCS)


def test_variants_of_a_few_letters(spark):
    """Few letters make crowded blocks, many ties, chains and words that grow by one letter."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        words = ["".join(rng.choice("abÿ") for _ in range(rng.choice([5, 6, 6, 7, 8, 40]))) for _ in range(30)]
        # Some words are far more frequent than others.
        words += [w for w in ("aaaaaa", "aaaaaab", "bbbbbbbb", "ababab") for _ in range(rng.randrange(8))]
        rows.append((i, rng.choice([" ", "1", "-\n"]).join(words).replace("a", rng.choice("aA"))))
    got = result(table_of(spark, rows).repartition(5), crowded=8, every=7)
    assert len(got) == len(set(got)) > 100
    assert set(got) == expected(rows, every=7)
    assert any(root != form for _, form, root, *_ in got if form)


def test_awkward_texts(spark):
    long = "q" * 70_000
    rows = [
        (1, None),
        (2, ""),
        (3, "Étranger étranger ÉTRANGER " * 5),
        (4, f"{long} {long[1:]} " * 5 + f"{long} " * 25),
        (5, "seldom" * 3 + " " + "colour " * 6 + "color colors " * 40),
        (None, "colour " * 4),
    ]
    table = table_of(spark, rows)
    again = table.unionByName(table.where("doc_id = 5 or doc_id is null"))
    want = expected([*rows, rows[4], rows[5]])
    assert set(result(again)) == want and len(want) > 4


def test_no_words(spark):
    assert result(table_of(spark, [(1, "a b c"), (2, None)])) == []
    assert result(table_of(spark, []).limit(0)) == []


@pytest.mark.skipif(not os.path.isdir(f"{TESTDATA}/sf0.001"), reason="no test tables")
def test_query_equals_brute_force(spark):
    from samekin.llm.queries import QUERIES

    found = QUERIES["op12_spelling"](spark, f"{TESTDATA}/sf0.001")
    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == sorted(expected(map(tuple, rows)))
