"""Aligned tokens against the tokenizers on whole texts and a plain look at all token pairs."""

import collections
import hashlib
import os
import random

import pytest

from samekin.llm import alignment
from samekin.llm.tokens import default_pieces, default_vocabulary

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
DOCS = "doc_id long, text string, batch long, n_a string, a string, numbers string"

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def plain():
    side_a = tokenizers.Tokenizer.from_file(default_vocabulary().replace(".tiktoken", ".json"))
    side_a.encode_special_tokens = True
    side_b = sentencepiece.SentencePieceProcessor(model_file=default_pieces())
    # The table of byte-level BPE: printable bytes stand for themselves, the others follow from 256.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}

    def encode(text):
        """Two lists of (id, bytes)."""
        a = [(i, bytes(letters[c] for c in side_a.id_to_token(i))) for i in side_a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in side_b.encode(text):
            piece = side_b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if side_b.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    return encode


def expected(texts, encode):
    told, counts = [], collections.Counter()
    for text in texts:
        a, b = encode(text) if text else ([], [])
        data = (" " + text).encode() if text else b""
        if any(b"".join(t for _, t in side) != data for side in (a, b)):
            a, b = [], []
        ends = []
        for side in (a, b):
            stop, spans = 0, []
            for i, token in side:
                spans.append((i, stop, stop + len(token)))
                stop += len(token)
            ends.append(spans)
        a, b = ends
        links = []
        low = 0
        for i, start, end in a:
            while low < len(b) and b[low][2] <= start:
                low += 1
            at = low
            while at < len(b) and b[at][1] < end:
                links.append((i, b[at][0]))
                at += 1
        counts.update(links)
        common = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, at = [], [0, 0]
        for end in common:
            inside = []
            for k, side in enumerate((a, b)):
                begin = at[k]
                while at[k] < len(side) and side[at[k]][2] <= end:
                    at[k] += 1
                inside.append(",".join(str(i) for i, _, _ in side[begin : at[k]]))
            groups.append("|".join(inside))
        told.append((len(a), len(b), len(groups), links, ";".join(groups)))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (
            n_a,
            n_b,
            n_groups,
            len(links),
            sum(counts[p] == most[p[1]] for p in links),
            sum(counts[p] for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, n_groups, links, groups in told
    ]


def found(table, **options):
    rows = alignment.aligned_tokens(table, **options).collect()
    return collections.Counter(tuple(r) for r in rows)


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "a", "b", "c") for i, t in rows], DOCS)


AWKWARD = [
    None,
    "",
    " ",
    "   ",
    "\n",
    " \n \t  x",
    "word",
    "word ",
    " word",
    "two  spaces\n  and\r\n\r\nlines ",
    "don't we'll I'M 12345 ----- ???",
    "a<|endoftext|>b <s> </s> <unk> <0x41>",
    "under▁score ▁ mark",
    "nul\x00byte\x7f\u0085  　 ideographic​",
    "ünï çødé 😀👩‍👩‍👧 汉字かな 한국어 עברית é",
    "😀" * 50,
    "x" * 5_000,
    " " * 3_000,
    "\t\n " * 500,
]


def test_links_equal_plain_overlaps(spark, plain):
    rng = random.Random(3)
    bits = ["the", "Über", " ", " ", "  ", "\n", "123", "'s", "-", "é", "😀", "tion", ".", "汉", " ", "▁"]
    texts = AWKWARD + ["".join(rng.choice(bits[: rng.randrange(2, 17)]) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += texts[:30]
    texts.append("lorem ipsum, dolor sit amet\n" * 8_000)
    rows = list(enumerate(texts))
    rows.append((None, "no id"))
    want = expected([t for _, t in rows], plain)
    assert any(w[0] for w in want[13:15])
    got = found(table_of(spark, rows).repartition(3), batch_bytes=500)
    assert got == collections.Counter((i, *w) for (i, _), w in zip(rows, want))


def test_no_rows(spark):
    assert not found(table_of(spark, []).limit(0))
    assert found(table_of(spark, [(1, None), (2, "")])) == {(1, *[0] * 6, ""): 1, (2, *[0] * 6, ""): 1}


def test_forgetting_changes_nothing(spark, plain, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 20)
    alignment._memories.clear()
    for _ in range(3):
        for text in AWKWARD:
            sides = alignment.tokens_of([text], default_vocabulary(), default_pieces())
            ids = [[i for i, _ in side] for side in plain(text)] if text else [[], []]
            if len(sides[0].id):
                assert [s.id.tolist() for s in sides] == ids


@pytest.mark.skipif(not os.path.isdir(f"{TESTDATA}/sf0.001"), reason="no test tables")
def test_query_equals_plain_overlaps(spark, plain):
    from samekin.llm.queries import QUERIES

    rows = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = expected([r["text"] for r in rows], plain)
    result = QUERIES["op11_alignment"](spark, f"{TESTDATA}/sf0.001")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert result.columns == names
    assert {tuple(r) for r in result.collect()} == {(r["doc_id"], *w) for r, w in zip(rows, want)}
