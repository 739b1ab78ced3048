"""Operators on texts: empty and long ones, nulls, repeated rows, clashing columns, no rows."""

import collections
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from samekin.llm import packing, quality, rules, sharding, text, toxicity, training_order
from samekin.llm.jaccard import one_of_each
from samekin.llm.mixing import mixed, mixing_rates
from samekin.llm.pii import boost, personal_spans, train_pii, without_personal_data
from samekin.llm.queries import ORACLE_SQL, QUERIES
from samekin.llm.toxicity import without_toxic
from tests.oracle_check import connect, difference

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
DOCS = "doc_id long, text string, shard string, slot string, rate string, base string"
LABELS = "doc_id long, quality int, toxic int"
LONG = "lorem ipsum dolor " * 60_000


def documents(spark, texts):
    rows = [(i, t, "a", "b", "c", "d") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def awkward(spark):
    texts = [None, "", " \n", "one", "ünï çødé 😀 text", LONG, "same same", "same same"]
    table = documents(spark, texts)
    return table.unionByName(table.where("doc_id = 6")).repartition(2)


@pytest.mark.parametrize("separators", [text.SPACES, text.NO_LETTERS])
def test_word_hashes_tell_words_apart(separators):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aAbB é1 \n.\t") for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += ["", "x" * (text.CHUNK + 5) + " tail", " "]
    encoded = text.encoded(texts)
    pattern = rb"[^\x20\x09-\x0D]+" if separators is text.SPACES else rb"[A-Za-z\x80-\xff]+"
    hashes, offsets = text.word_hashes(encoded, separators)
    names = {}
    for i, t in enumerate(encoded):
        words = re.findall(pattern, t.lower())
        assert len(words) == offsets[i + 1] - offsets[i]
        for word, h in zip(words, hashes[offsets[i] : offsets[i + 1]]):
            assert names.setdefault(word, h) == h
    assert len(set(names.values())) == len(names)


def test_packing_round_trip(spark):
    table = awkward(spark)
    found = packing.pack_binary(table).toPandas()
    assert sorted(found.sequence_id) == list(range(len(found)))
    assert (found.offset == 0).all() and set(found.length) <= {1 << i for i in range(12)}
    assert list(found.sort_values("sequence_id").length) == sorted(found.length)
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    library = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    for doc_id, own in found.groupby("doc_id"):
        body = table.where(F.col("doc_id") == doc_id).first().text or ""
        ids = np.array(library.encode(body, add_special_tokens=False).ids + [1], "<u4")
        copies = 2 if doc_id == 6 else 1
        assert own.length.sum() == copies * len(ids) == copies * own.doc_tokens.iloc[0]
        for piece in own.itertuples():
            expected = ids[piece.start : piece.start + piece.length].tobytes()
            assert piece.ids == expected and piece.ids_crc32 == zlib.crc32(expected)
    assert packing.pack_binary(table.limit(0)).collect() == []
    assert list(packing.binary_lengths(2048 * 2 + 13)) == [2048, 2048, 8, 4, 1]


def test_training_order_round_trip(spark, tmp_path):
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        for key in (1, 99):
            slots = training_order.feistel(np.arange(n), n, key)
            assert sorted(slots) == list(range(n))
    assert list(training_order.feistel(np.arange(1000), 1000, 1)) != list(training_order.feistel(np.arange(1000), 1000, 2))
    table = awkward(spark)
    shards = training_order.training_shards(table, length=64, shard_sequences=16)
    path = str(tmp_path / "shards")
    training_order.write_training_shards(shards, path)
    found = training_order.records(spark.read.parquet(path)).toPandas()
    assert sorted(found.slot) == list(range(len(found)))
    assert (found.shard == found.slot // 16).all()
    stride = training_order.RECORD.itemsize + 2 * 64
    assert (found.offset == found.slot % 16 * stride).all()
    for row in table.where("doc_id <> 6").collect():
        ids = training_order.token_ids(row.text, training_order.default_vocabulary())
        ids = np.append(ids, training_order.END_ID).astype("<u2")
        own = found[found.doc_id == row.doc_id].sort_values("start")
        assert own.length.sum() == len(ids)
        expected = [zlib.crc32(ids[i : i + 64].tobytes()) for i in range(0, len(ids), 64)]
        assert list(own.ids_crc32) == expected
    resumed = training_order.records(training_order.read_from(spark, path, 40)).toPandas()
    assert resumed.slot.min() == 32
    assert training_order.training_shards(table.limit(0)).collect() == []


def test_shards_are_even_and_gapless(spark):
    rng = random.Random(2)
    texts = ["x" * rng.randrange(400) for _ in range(900)] + ["same text " * 12] * 700 + [None, "", "é" * 99]
    table = documents(spark, texts)
    found = sharding.histogram_shards(table.repartition(4), 8, piece_bytes=4_000)
    assert found.columns == ["doc_id", "text", "rate", "base", "shard", "slot"]
    rows = found.toPandas()
    assert sorted(rows.doc_id) == list(range(len(texts)))
    sizes = rows.assign(size=[len((t or "").encode()) + 8 for t in rows.text]).groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 2 * 410
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    # Equal texts lie side by side: at most the shards in a row that their bytes fill.
    shards = sorted(set(rows[rows.text == "same text " * 12].shard))
    assert shards == list(range(shards[0], shards[-1] + 1)) and len(shards) <= 6
    assert sharding.histogram_shards(table.limit(0), 8).collect() == []
    assert sharding.histogram_shards(awkward(spark), 3).count() == 9


def toxic_corpus(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdgk" for b in "aeiou" for c in ("lo", "mi", "nu", "tar")]
    texts, toxic = [], []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randrange(20, 60))]
        toxic.append(int(i % 5 == 0))
        for _ in range(rng.randrange(1, 6) if toxic[-1] else 0):
            body.insert(rng.randrange(len(body)), rng.choice(["vilest,", "Scoundrel", "scoundrelly", "rotten!"]))
        texts.append(" ".join(body))
    return texts, toxic


def test_toxicity_chooses_features_without_sorting_all_of_them():
    """The driver holds counts of fixed size beside the features of the sample, not copies of these."""
    draw = np.random.default_rng(3)
    toxic = np.arange(300) % 3 == 0
    found = [np.sort(draw.choice(50_000, 20_000, replace=False)).astype(np.uint32) for _ in toxic]
    for own, flag in zip(found, toxic):
        own[0] = 60_000 if flag else 70_000
    tracemalloc.start()
    chosen = toxicity._chosen(found, toxic)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert chosen.tolist() == [60_000]
    assert peak < 64 << 20


def test_toxicity_on_unseen_documents(spark):
    texts, toxic = toxic_corpus(1, 800)
    table = documents(spark, texts)
    labels = spark.createDataFrame(
        [(i, 1, t) for i, t in enumerate(toxic) if i < 500] + [(1, 1, None), (99_999, 0, 1)], LABELS
    )
    model = toxicity.train_severity(table, labels)
    assert (np.diff(model.cuts) > 0).all()
    found = {r.doc_id: r for r in toxicity.toxicity(table, model).collect()}
    assert len(found) == 800
    unseen = [found[i].toxic == bool(toxic[i]) for i in range(500, 800)]
    assert sum(unseen) >= 295
    few, many = ("vilest a b", "vilest scoundrel rotten scoundrelly vilest")
    scored = toxicity.toxicity(documents(spark, [few, many]), model).orderBy("doc_id").collect()
    assert scored[0].severity < scored[1].severity
    clean = toxicity.without_toxic(table, model)
    assert clean.columns == table.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, r in found.items() if not r.toxic}
    assert toxicity.toxicity(awkward(spark), model).where("toxic").count() == 0
    assert toxicity.toxicity(table.limit(0), model).collect() == []
    untaught = toxicity.train_severity(table, labels.where("toxic = 0"))
    assert toxicity.toxicity(table, untaught).where("toxic").count() == 0


def test_quality_on_held_out_documents(spark):
    rng = random.Random(4)
    texts, good = [], []
    for i in range(700):
        body = " ".join(rng.choice(["stone", "river", "winter", "garden", "letter"]) for _ in range(120))
        good.append(int(i % 4 > 0))
        # A bad document has one bad passage among good ones.
        texts.append(body if good[-1] else body + " $$$ ### a|b|c|" * 30 + body)
    table = documents(spark, texts)
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good)] + [(3, None, 0)], LABELS)
    found = quality.quality(table, quality.train_quality(table, labels)).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(700) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == good[r.doc_id] for r in held) >= 0.95 * len(held)
    odd = quality.quality(awkward(spark), quality.train_quality(table, labels)).collect()
    assert len(odd) == 9 and all(0 <= r.score <= 1 for r in odd)
    assert quality.train_quality(table, labels.where("quality = 1")) is None
    assert {r.score for r in quality.quality(table, None).collect()} == {0.5}
    assert quality.quality(table.limit(0), None).collect() == []


def brute_counts(body):
    body = body or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", body)
    lines = [x for x in body.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(windows)
    twice = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    symbols = sum(c in "#*$%&|<>" for c in body)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(twice)


def test_rule_counts_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [
        "".join(rng.choice(["a ", "b ", "c\t", "#", "line\n", "\n", "é😀 ", "$ x", "\x0b", "\x85"]) for _ in range(rng.randrange(120)))
        for _ in range(150)
    ]
    texts += [None, "", " \n \n", "a b c d e", "x\r\nx\r\n", "one two three four five six " * 400]
    found = rules.weak_supervision(documents(spark, texts)).collect()
    assert len(found) == len(texts)
    for row in found:
        assert tuple(row[1:6]) == brute_counts(texts[row.doc_id]), texts[row.doc_id]
        assert row.base_failed == (row.n_words < 10 or 100 * row.n_repeat_words > 20 * row.n_words)
        assert not (row.base_failed and row.kept) and 0 <= row.posterior <= 1
    assert rules.weak_supervision(documents(spark, texts).limit(0)).collect() == []


def test_em_finds_how_far_rules_can_be_trusted():
    rng = random.Random(8)
    right = [0.95, 0.9, 0.85, 0.7, 0.9]
    patterns = collections.Counter()
    for _ in range(6000):
        good = rng.random() < 0.7
        votes = [0 if rng.random() < 0.3 else (1 if (rng.random() < r) == good else -1) for r in right]
        patterns[tuple(votes)] += 1
    model = rules.estimate(patterns, [rules.START] * len(right))
    # The start weighs in, so the order is what counts.
    assert all(model.accuracy(i)[0] > model.accuracy(3)[0] for i in (0, 1, 2, 4))
    assert all(abs(model.accuracy(i)[1] - r) < 0.15 for i, r in enumerate(right))


def brute_spans(body):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, body or ""):
            digits = [int(c) for c in re.sub("[^0-9]", "", m.group())]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(digits[::-1]))
                if not 12 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), rank, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(9)
    parts = [
        "ab.c@d-e.fg", "@", "a@b.c_x@d.e", "1.2.3.4", "300.1.2.3", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112",
        "+1 (555) 123-4567", "+12", "+1 2 3 4 5 6 7 8 9", " ", "-", ".", "7", "é😀", "a@b..c", "x%y@z.q+r@s.t", "\n", "00012.0.0.1",
    ]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(14))) for _ in range(400)]
    texts += [None, "", "9" * 50_000, "a" * 50_000, "a@b" + ".c" * 20_000, "1.2.3.4 " * 700, "(" * 20_000 + "+1" + " " * 20_000]
    table = documents(spark, texts)
    found = personal_spans(table, train_pii(table)).collect()
    assert len(found) == len(texts)
    for row in found:
        assert [(s.kind, s.start, s.end) for s in row.base] == brute_spans(texts[row.doc_id]), texts[row.doc_id]
        assert all((texts[row.doc_id])[s.start : s.end] == s.match for s in row.base + row.added)
    assert personal_spans(table.limit(0), train_pii(table.limit(0))).collect() == []


def test_boosting_adds_only_what_its_labels_bear_out():
    # Bit 0 decides; bit 1 does not matter.
    counts = {(True, True): (0.0, 300.0), (True, False): (1.0, 300.0), (False, True): (300.0, 0.0), (False, False): (300.0, 1.0)}
    model = boost(counts, 2)
    assert model.stumps[0][0] == 0 and model.threshold < float("inf")
    assert boost({(True, False): (10.0, 0.0)}, 2).threshold == float("inf")


def test_redaction(spark):
    texts = ["Write to x@y.org, or +1 (555) 123-4567.", "é 1.2.3.4 😀 x@y.org", None, "", "clean"]
    table = documents(spark, texts)
    found = without_personal_data(table)
    assert found.columns == table.columns
    assert [r.text for r in found.orderBy("doc_id").collect()] == [
        "Write to [EMAIL], or [PHONE].", "é [IP] 😀 [EMAIL]", None, "", "clean",
    ]


def test_mixing_meets_its_targets(spark):
    rng = random.Random(11)
    plain = lambda: " ".join(rng.choice(["stone", "river", "winter.", "garden,"]) for _ in range(rng.randrange(40, 90)))
    junk = lambda: " ".join(rng.choice(["A|B", "$$$", "XX!!"]) for _ in range(rng.randrange(40, 90)))
    texts = [junk() if i % 4 == 0 else plain() for i in range(400)] + [None, "", " "]
    table = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(200)] + [(7, None, None)], LABELS)
    found = mixing_rates(table, labels, {"good": 0.9, "poor": 0.1, "toxic": 0.0}).toPandas()
    assert len(found) == len(texts) and (found.rate >= 0).all()
    # The same by numpy, from the posteriors.
    shares = found[["p_good", "p_poor", "p_toxic"]].to_numpy()
    tokens = found.tokens.to_numpy()
    sizes = tokens @ shares
    wanted = np.array([0.9, 0.1, 0]) * tokens.sum()
    rate = np.ones(len(found))
    for _ in range(300):
        error = (wanted - (tokens * rate) @ shares) / np.maximum(sizes, 1e-9)
        rate = np.maximum(0, rate + shares @ np.where(sizes > 1e-6 * tokens.sum(), error, 0))
    assert np.abs(rate - found.rate).max() < 0.01
    reached = (tokens * found.rate.to_numpy()) @ shares / tokens.sum()
    assert abs(reached[0] - 0.9) < 0.001 and abs(reached[1] - 0.1) < 0.001
    rows = mixed(table, labels, {"good": 0.5, "poor": 0.5, "toxic": 0.0}, epochs=2.0, least=1.0)
    assert rows.columns == table.columns
    ids = [r.doc_id for r in rows.collect()]
    assert set(ids) == set(range(len(texts))) and len(ids) > 1.3 * len(texts)
    assert mixing_rates(table.limit(0), labels).collect() == []
    assert mixing_rates(table, labels.limit(0)).count() == len(texts)


@pytest.mark.skipif(not os.path.isdir(f"{TESTDATA}/sf0.001"), reason="no test tables")
def test_queries_with_sql(spark):
    con = connect(f"{TESTDATA}/sf0.001")
    for name, sql in ORACLE_SQL.items():
        found, _ = difference(spark, con, QUERIES[name], sql, f"{TESTDATA}/sf0.001")
        assert found is None


@pytest.mark.skipif(not os.path.isdir(f"{TESTDATA}/sf0.01"), reason="no test tables")
def test_pipeline_stages(spark):
    sf_dir = f"{TESTDATA}/sf0.01"
    before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, kept = before, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == before.columns
    order = list(kept)
    assert all(kept[b] <= kept[a] for a, b in zip(order, order[1:]))
    assert kept["near_duplicates"] == kept["pii"] == kept["mixing"] == kept["packing"]
    assert len(kept["toxicity"]) < before.count()
    assert "pipeline" not in ORACLE_SQL and corpus_pipeline.ORACLE_SQL is None


def test_mixing_knows_held_out_toxic_documents_by_their_words(spark):
    texts, toxic = toxic_corpus(12, 800)
    table = documents(spark, texts)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic) if i < 500], LABELS)
    found = mixing_rates(table, labels, {"good": 0.98, "poor": 0.0, "toxic": 0.02}).toPandas()
    found["toxic"] = found.doc_id.map(dict(enumerate(toxic)))
    held_out = found[found.doc_id >= 500]
    assert held_out.p_toxic[held_out.toxic == 1].mean() > 0.9
    assert held_out.p_toxic[held_out.toxic == 0].mean() < 0.05
    for rows in (found, held_out):
        seen = rows.tokens * rows.rate
        assert rows.tokens[rows.toxic == 1].sum() > 0.15 * rows.tokens.sum()
        assert abs(seen[rows.toxic == 1].sum() / seen.sum() - 0.02) < 0.01


def test_added_tokens_inside_texts_keep_their_ids(spark):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    library = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"é{end}\n {end}😀 x", f"{end[:-1]} {end[1:]} <|END|>", f"  {end}  ", "plain"]
    table = documents(spark, texts)
    found = packing.pack_binary(table).toPandas()
    assert set(found.doc_id) == set(range(len(texts)))
    for doc_id, own in found.groupby("doc_id"):
        ids = library.encode(texts[doc_id], add_special_tokens=False).ids
        assert own.doc_tokens.iloc[0] == own.length.sum() == len(ids) + 1
        assert b"".join(own.sort_values("start").ids) == np.array([*ids, 1], "<u4").tobytes()
        assert (50256 in ids) == (end in texts[doc_id])


@pytest.mark.parametrize("poor_every", [2, 7])
def test_mixing_stage_reaches_the_targets(spark, monkeypatch, poor_every):
    rng = random.Random(13)
    prose = ["stone", "river", "winter.", "garden,", "meadow", "harbour"]
    junk = ["A|B", "$$$", "XX!!", "Q#Z"]
    poor = [i % poor_every == 0 for i in range(1200)]
    texts = [" ".join(rng.choices(junk if p else prose, k=rng.randrange(40, 90))) for p in poor]
    table = documents(spark, texts)
    labels = spark.createDataFrame(
        [(i, int(not p), 0) for i, p in enumerate(poor) if i < 600] + [(1_000_000, 1, 1)], LABELS
    )
    monkeypatch.setattr(corpus_pipeline, "_labels", lambda spark, sf_dir: labels)
    mixture = corpus_pipeline.mix_to_targets(spark, table, "").toPandas()
    assert set(mixture.doc_id) == set(range(len(texts)))
    tokens = np.array([len(t.split()) for t in texts])
    seen = np.bincount(mixture.doc_id, minlength=len(texts))
    reached = (tokens * seen)[poor].sum() / (tokens * seen).sum()
    assert abs(reached - 0.08 / 0.98) < 0.01
    # The same by numpy: junk once, prose as often as needed.
    size = tokens[poor].sum()
    times = (size / (0.08 / 0.98) - size) / (tokens.sum() - size)
    prose_seen = seen[~np.array(poor)]
    assert (seen[poor] == 1).mean() > 0.98 and abs(prose_seen.mean() - times) < 0.03 * times


def test_personal_data_beyond_the_base_is_added_and_lookalikes_stay(spark):
    rng = random.Random(14)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    taught = []
    for _ in range(300):
        ip = ".".join(str(rng.randrange(20, 256)) for _ in range(4))
        email = f"{rng.choice(['ann', 'bo', 'cy'])}.{digits(2)}@mail{digits(1)}.example.com"
        taught.append(f"stone {email}, river {ip} winter +1 ({digits(3)}) 555-{digits(4)} meadow {digits(8)}")
    planted = {
        "phone: (415) 555-0133 now": ["(415) 555-0133"],
        "mobile 415-555-0133": ["415-555-0133"],
        "write to jane.doe (at) example (dot) com today": ["jane.doe (at) example (dot) com"],
        "at jane[at]example.org": ["jane[at]example.org"],
        "mail info@müller.de": ["info@müller.de"],
        "host 192[.]168[.]17[.]45 is up": ["192[.]168[.]17[.]45"],
    }
    lookalikes = [
        "on 2024-05-17 1230 it", "isbn 978-3-16-148410-0", "order 4155550133", "see user@host or @handle", "cost a@b.5?x@y",
        "we met (at) noon.Then left", "section 1[.]2[.]3[.]4", "host 300[.]168[.]17[.]45", "call 555-0133", "id 123.456.789",
    ]
    table = documents(spark, [*taught, *planted, *lookalikes])
    models = train_pii(table)
    rows = personal_spans(table.where(F.col("doc_id") >= 300), models).orderBy("doc_id").collect()
    found = [[s.match for s in r.added] for r in rows]
    assert found == [*planted.values(), *[[] for _ in lookalikes]]


def test_columns_called_like_those_of_the_operators(spark):
    """They come back as they were."""
    names = "_key _size _piece _rank _before base added _one _candidates _Kept _shares _length _text _copy".split()
    rows = [(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(["a b c", "mail me@site.org", None, "", "a b c"])]
    table = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], LABELS)

    def others(found):
        kept = found.select("doc_id", *names).distinct().collect()
        assert {tuple(r) for r in kept} <= {(r[0], *r[2:]) for r in rows}
        return {r["doc_id"] for r in kept}

    assert others(sharding.histogram_shards(table, 2)) == {0, 1, 2, 3, 4}
    assert others(without_personal_data(table)) == {0, 1, 2, 3, 4}
    assert others(one_of_each(table)) == {0, 1, 2, 3}
    assert others(mixed(table, labels, least=1.0)) == {0, 1, 2, 3, 4}
    redacted = {r["doc_id"]: r["text"] for r in without_personal_data(table).collect()}
    assert redacted[1] == "mail [EMAIL]" and redacted[2] is None and redacted[3] == ""


def test_pipeline_of_no_documents(spark):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 1)], LABELS)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs = without_toxic(docs, toxicity.train_severity(docs, labels))
    for stage in (one_of_each, without_personal_data, lambda d: mixed(d, labels, epochs=None, least=1.0)):
        docs = stage(docs)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0
    assert packing.pack_binary(docs).count() == 0
