"""Near-duplicate classes by a parity-sketch join of word shingles.

A document's sketch is cut into p parts. Every shingle falls into one part and is XOR-ed into it, so
what two documents share cancels out and at most |A xor B| parts differ. At a Jaccard similarity of
3/4 the symmetric difference is at most (|A| + |B|) / 7. Hence, of a document's filled parts, any
d + 1 contain one that a partner has too (pigeonhole); which ones are sent is free as long as all
documents choose alike, and the choice falls on parts of rare shingles. Parts are compared within
bands of set size. Pairs that meet are tested by the Hamming distance of a short bit sketch, made by
the same XOR and so never above the symmetric difference, and what passes is verified on the texts.

Parts that many documents send are not expanded into pairs: their documents are linked through the
smallest one, and only those that are left apart are compared among each other, by bit sketches.
"""

from __future__ import annotations

import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samekin.llm.store import set_aside, written
from samekin.llm.text import encoded, in_batches, mixed, sliced, word_hashes
from samekin.operators.components import contract_to_stars

SHINGLE_WORDS = 5
# Similarity 3/4: 4 * shared >= 3 * all, and a symmetric difference of at most a seventh of the sizes.
SHARED, OF_ALL, SEVENTH = 4, 3, 7
# Sizes from BAND ** k up to the next power share a band. Below SMALL every shingle is a part.
BAND = 4
SMALL = 64
# Counters of how many documents have a shingle. They only order parts, so collisions cost time,
# not results; their size is fixed.
COUNTERS_BITS = 22
CHUNK_BITS = 16
# Partial counters added up at once.
MERGED = 64
# Signatures of a task that are packed together.
SENT_TOGETHER = 1 << 18
# Parts sent by more documents are linked through one of them.
RUN = 24
# Documents of such a part that are compared in one task.
TILE = 2_048
# Up to so many pairs, and so many ids, are broadcast; they take 80 and 16 bytes each.
BROADCAST_PAIRS = 250_000
BROADCAST_IDS = 1_000_000
# Bits of the short sketch for each shingle, to the next power of two.
SKETCH_BITS = 4

_U = np.uint64
_PAIR = "a long, b long"


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending: of five words in a row, or of all words
    where there are fewer."""
    words, offsets = word_hashes(texts)
    five = np.zeros(max(0, len(words) - SHINGLE_WORDS + 1), _U)
    for i in range(SHINGLE_WORDS):
        # One after the other, so that the order of the words counts.
        five = mixed(five * _U(0x9FB21C651E98DF25) + words[i : i + len(five)])
    for begin, end in zip(offsets, offsets[1:]):
        if end - begin >= SHINGLE_WORDS:
            yield np.unique(five[begin : end - SHINGLE_WORDS + 1])
        elif end > begin:
            whole = np.full(1, end - begin, _U)
            for word in words[begin:end]:
                whole = mixed(whole * _U(0x9FB21C651E98DF25) + word)
            yield whole
        else:
            yield np.zeros(0, _U)


def set_key(shingles: np.ndarray) -> int:
    """A 64-bit name of a set."""
    total = mixed(shingles + _U(len(shingles))).sum(dtype=_U)
    return int(mixed(np.array([total]))[0].astype(np.int64))


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """A bit for each of 2**k places: the parity of the shingles that fall there, as bytes."""
    size = 1 << max(6, int(SKETCH_BITS * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & _U(size - 1)).astype(np.int64), minlength=size)
    return np.packbits(counts & 1)


def hamming(a: np.ndarray, b: np.ndarray) -> int:
    """Distance of two sketches; the longer one is folded by XOR to the size of the shorter."""
    if len(a) < len(b):
        a, b = b, a
    folded = np.bitwise_xor.reduce(a.reshape(-1, len(b)), axis=0)
    return int(np.bitwise_count(folded ^ b).sum())


def allowed(sizes_a, sizes_b):
    """The largest symmetric difference of a linked pair; -1 if the sizes alone rule it out."""
    small, large = np.minimum(sizes_a, sizes_b), np.maximum(sizes_a, sizes_b)
    return np.where(SHARED * small >= OF_ALL * large, (sizes_a + sizes_b) // SEVENTH, -1)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared > 0 and SHARED * shared >= OF_ALL * (len(a) + len(b) - shared)


def _bands(n: int) -> Iterator[tuple[int, int, int]]:
    """The bands a set of n shingles has partners in, with the number of parts and with d. A pair
    belongs to the band of its smaller set."""
    edge = 1
    while edge * BAND <= n:
        edge *= BAND
    parts = edge * BAND if edge >= SMALL else 1 << 40
    yield edge, parts, (n + n * SHARED // OF_ALL) // SEVENTH
    if edge > 1 and SHARED * (edge - 1) >= OF_ALL * n:
        parts = edge if edge // BAND >= SMALL else 1 << 40
        yield edge // BAND, parts, (n + edge - 1) // SEVENTH


def signatures(shingles: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """What a set sends: in each band the d + 1 filled parts of the rarest shingles. Equal parts
    have equal signatures and are equally rare, so all documents choose alike."""
    seen = counters[(shingles >> _U(64 - COUNTERS_BITS)).astype(np.int64)]
    sent = []
    for edge, parts, d in _bands(len(shingles)):
        # The part must not depend on the bits that other sketches use.
        part = mixed(shingles ^ _U(edge)) % _U(parts)
        order = np.argsort(part, kind="stable")
        first = np.flatnonzero(np.diff(part[order], prepend=part[order[:1]] + _U(1)))
        parity = np.bitwise_xor.reduceat(mixed(shingles[order]), first)
        rarest = np.minimum.reduceat(seen[order], first)
        # The band by its exponent: edges themselves outgrow the bits above the part.
        band = _U(edge.bit_length() << 44)
        names = mixed(parity + mixed(part[order[first]] + band))
        sent.append(names[np.lexsort((names, rarest))[: d + 1]])
    return np.concatenate(sent) if sent else np.zeros(0, _U)


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))


def _sets(texts: DataFrame) -> DataFrame:
    """A row for each document: id, number of shingles, key, bit sketch; and the counters that the
    rows of a partition add up to, in chunks. Both need one pass, so they share a table."""
    names = ["chunk", "part", "doc_id", "n", "key", "bits"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << COUNTERS_BITS, np.uint32)

        def rows(columns: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in sliced(batches):
            texts, ids = encoded(batch["_text"].to_pylist()), batch["_id"].to_pylist()
            for part in in_batches(texts):
                sets = list(shingle_sets(texts[part]))
                if not sets:
                    continue
                places = (np.concatenate(sets) >> _U(64 - COUNTERS_BITS)).astype(np.int64)
                np.add.at(counters, places, np.uint32(1))
                blank = [None] * len(sets)
                keys = [set_key(s) for s in sets]
                bits = [bit_sketch(s).tobytes() for s in sets]
                yield rows([blank, blank, ids[part], [len(s) for s in sets], keys, bits])
        task = TaskContext.get().partitionId()
        for chunk, values in enumerate(counters.reshape(-1, 1 << CHUNK_BITS)):
            if values.any():
                packed = zlib.compress(values.tobytes(), 1)
                yield rows([[chunk], [task], [None], [None], [None], [packed]])

    return texts.mapInArrow(made, "chunk int, part int, doc_id long, n long, key long, bits binary")


def _counters(partial: DataFrame) -> np.ndarray:
    """The partial counters of all partitions, added up in levels so that no task gets more than
    ``MERGED`` of them."""

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << CHUNK_BITS, np.uint64)
        for packed in rows["bits"]:
            total += np.frombuffer(zlib.decompress(packed), np.uint32)
        values = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        first = rows.iloc[0]
        return pd.DataFrame(
            {
                "chunk": [first["chunk"]],
                "part": [first["part"] // MERGED],
                "bits": [zlib.compress(values.tobytes(), 1)],
            }
        )

    level = partial.select("chunk", "part", "bits")
    most = level.agg(F.max("part")).first()[0]
    while most is not None:
        level = level.groupBy("chunk", F.floor(F.col("part") / MERGED)).applyInPandas(
            merged, "chunk int, part int, bits binary"
        )
        if most < MERGED:
            break
        level, most = written(level, "counters"), most // MERGED
    counters = np.zeros(1 << COUNTERS_BITS, np.uint32)
    for row in level.select("chunk", "bits").collect() if most is not None else []:
        begin = row["chunk"] << CHUNK_BITS
        values = np.frombuffer(zlib.decompress(row["bits"]), np.uint32)
        counters[begin : begin + len(values)] = values
    return counters


def _sent(texts: DataFrame, counters: Broadcast, partitions: int) -> DataFrame:
    """``sig``, ``key`` for every signature of every text, all rows of a signature in one partition.

    They are sent in parcels: a row holds the part of a batch that goes to one partition. Copies within
    a batch are sent once."""

    def parcels(sigs: np.ndarray, docs: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((keys[docs], sigs))
        sigs, keys = sigs[order], keys[docs[order]]
        new = np.ones(len(sigs), bool)
        new[1:] = (np.diff(sigs) != 0) | (np.diff(keys) != 0)
        sigs, keys = sigs[new], keys[new]
        target = ((sigs >> _U(32)) * _U(partitions) >> _U(32)).astype(np.int32)
        first = np.flatnonzero(np.diff(target, prepend=-1))
        cuts = pa.array(np.append(first, len(sigs)), pa.int32())
        lists = [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (sigs.view(np.int64), keys)]
        return pa.RecordBatch.from_arrays([pa.array(target[first]), *lists], ["target", "sigs", "keys"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, keys, held = [], [], 0

        def flushed() -> pa.RecordBatch:
            docs = np.repeat(np.arange(len(keys)), [len(x) for x in names])
            return parcels(np.concatenate(names), docs, np.array(keys, np.int64))

        for batch in sliced(batches):
            texts = encoded(batch["_text"].to_pylist())
            for part in in_batches(texts, 1 << 19):
                for shingles in shingle_sets(texts[part]):
                    if len(shingles):
                        names.append(signatures(shingles, counters.value))
                        keys.append(set_key(shingles))
                        held += len(names[-1])
                    if held >= SENT_TOGETHER:
                        yield flushed()
                        names, keys, held = [], [], 0
        if held:
            yield flushed()

    sent = texts.mapInArrow(made, "target int, sigs array<long>, keys array<long>")
    # Taken apart by Spark, so that a task has one Python worker behind the shuffle, not two.
    return sent.repartitionById(partitions, "target").select(
        F.inline(F.arrays_zip(F.col("sigs").alias("sig"), F.col("keys").alias("key")))
    )


def _meetings(sent: DataFrame, run: int) -> DataFrame:
    """Pairs of documents with a common signature, and the members of crowded signatures. The rows
    of a partition are sorted by signature and stream through, so a signature may have any number
    of documents.

    Pairs have a null ``sig``. A signature of up to ``run`` documents gives all its pairs; a larger
    one gives a pair of each document with its smallest, and a row (``sig``, document) for each."""

    def rows(sig, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (sig, a, b)], ["sig", "a", "b"]
        )

    def pairs(sigs: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Of whole runs."""
        first = np.flatnonzero(np.diff(sigs, prepend=sigs[:1] - 1)) if len(sigs) else []
        sizes = np.diff(first, append=len(sigs))
        found = []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= run)]):
            at = first[sizes == size]
            x, y = np.triu_indices(size, 1)
            found.append(
                np.column_stack([keys[at[:, None] + x].ravel(), keys[at[:, None] + y].ravel()])
            )
        if found:
            unique = np.unique(np.concatenate(found), axis=0)
            yield rows(np.ma.masked_all(len(unique), np.int64).tolist(), unique[:, 0], unique[:, 1])
        for begin, size in zip(first, sizes):
            if size > run:
                yield from crowded(sigs[begin], keys[begin], keys[begin : begin + size])

    def crowded(sig, pivot, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        others = keys[keys != pivot]
        yield rows([None] * len(others), np.full(len(others), pivot), others)
        yield rows(np.full(len(keys), sig), keys, [None] * len(keys))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, keys = np.zeros(0, np.int64), np.zeros(0, np.int64)
        # The signature of a crowded run that is still going on, and its smallest document.
        going = pivot = None
        for batch in batches:
            sigs = np.concatenate([sigs, batch["sig"].to_numpy()])
            keys = np.concatenate([keys, batch["key"].to_numpy()])
            if not len(sigs):
                continue
            new = np.ones(len(sigs), bool)
            new[1:] = (np.diff(sigs) != 0) | (np.diff(keys) != 0)
            sigs, keys = sigs[new], keys[new]
            if going is not None:
                more = int(np.searchsorted(sigs, going, "right"))
                yield from crowded(going, pivot, keys[:more])
                sigs, keys = sigs[more:], keys[more:]
                if not len(sigs):
                    continue
                going = None
            last = int(np.searchsorted(sigs, sigs[-1]))
            yield from pairs(sigs[:last], keys[:last])
            sigs, keys = sigs[last:], keys[last:]
            if len(sigs) > run:
                going, pivot = sigs[0], keys[0]
                yield from crowded(going, pivot, keys)
                sigs, keys = sigs[:0], keys[:0]
        yield from pairs(sigs, keys)

    return sent.sortWithinPartitions("sig", "key").mapInArrow(made, "sig long, a long, b long")


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose sizes and bit sketches allow a link, with the documents that stand for them."""

    def side(name: str) -> DataFrame:
        return nodes.select(
            F.col("key").alias(name),
            F.col("doc_id").alias(f"{name}_id"),
            F.col("n").alias(f"{name}_n"),
            F.col("bits").alias(f"{name}_bits"),
        )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = allowed(batch["a_n"].to_numpy(), batch["b_n"].to_numpy())
            keep = [
                limit >= 0
                and hamming(np.frombuffer(x.as_py(), np.uint8), np.frombuffer(y.as_py(), np.uint8)) <= limit
                for limit, x, y in zip(most, batch["a_bits"], batch["b_bits"])
            ]
            yield batch.select(["a", "b", "a_id", "b_id"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "a_id", "b_id", "a_n", "b_n", "a_bits", "b_bits").mapInArrow(
        made, "a long, b long, a_id long, b_id long"
    )


def _verified(near: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are linked, as ``src``, ``dst``. Texts meet the pairs they are in: where they lie
    if the pairs are few by count, else in a shuffle. Then only texts of pairs are moved."""
    near = written(near, "near")
    ends = F.explode(
        F.array(
            *[F.struct(F.lit(i).alias("side"), F.col(f"{s}_id").alias("_id")) for i, s in enumerate("ab")]
        )
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[bytes, tuple[int, np.ndarray]] = OrderedDict()

        def known(text: bytes) -> tuple[int, np.ndarray]:
            if text not in held:
                shingles = next(shingle_sets([text]))
                held[text] = set_key(shingles), shingles
                if len(held) > 32:
                    held.popitem(last=False)
            return held[text]

        def wanted(texts: list[str], key: int) -> np.ndarray | None:
            # An id may stand for several rows; only the one that has the set counts.
            found = (known(t) for t in encoded(texts))
            return next((shingles for k, shingles in found if k == key), None)

        for batch in sliced(batches):
            keep = []
            for a, b, left, right in zip(*(batch[c].to_pylist() for c in ("a", "b", "left", "right"))):
                x, y = wanted(left, a), wanted(right, b)
                keep.append(x is not None and y is not None and linked(x, y))
            yield (
                batch.select(["a", "b"]).rename_columns(["src", "dst"]).filter(pa.array(keep, pa.bool_()))
            )

    sides = near.select("a", "b", ends.alias("end")).select("a", "b", "end.side", "end._id")
    if near.count() <= BROADCAST_PAIRS:
        sides = F.broadcast(sides)
    return (
        texts.join(sides, "_id")
        .groupBy("a", "b")
        .agg(
            F.collect_set(F.when(F.col("side") == 0, F.col("_text"))).alias("left"),
            F.collect_set(F.when(F.col("side") == 1, F.col("_text"))).alias("right"),
        )
        .mapInArrow(made, "src long, dst long")
    )


def _left_apart(members: DataFrame, nodes: DataFrame, mapping: DataFrame, tile: int) -> DataFrame:
    """Pairs of different components that share a crowded signature and whose bit sketches allow a
    link. Only signatures whose documents are not all in one component matter.

    Signatures go together by their smallest document, since documents that have one in common often
    have many. The documents of such a group are compared tile by tile: each comes once with its sketch
    and once, without, for each of its signatures; a pair is compared once, if it has any signature in
    common; and no pair leaves a task but those whose sketches are close."""
    labels = mapping.select(F.col("txId").alias("key"), F.col("resolvedEntityId").alias("label"))
    labelled = members.join(labels, "key", "left").select(
        "sig", "key", F.coalesce("label", "key").alias("label")
    )
    split = (
        labelled.groupBy("sig")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("key").alias("pivot"))
        .where(F.col("low") != F.col("high"))
        .select("sig", "pivot")
    )
    placed = written(labelled.join(split, "sig").distinct(), "apart")
    own = placed.groupBy("pivot", "key").agg(F.first("label").alias("label"))
    tiles = own.groupBy("pivot").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))

    def dealt(rows: DataFrame, *columns) -> DataFrame:
        known = rows.join(tiles, "pivot").withColumn("own", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
        others = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        pair = [F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
        return known.withColumn("other", others).select("pivot", *pair, "own", "key", *columns)

    nothing = F.lit(None)
    documents = dealt(
        own.join(nodes.select("key", "n", "bits"), "key"), nothing.cast("long").alias("sig"), "label", "n", "bits"
    )
    having = dealt(
        placed.select("pivot", "key", "sig"),
        "sig",
        *[nothing.cast(t).alias(c) for c, t in (("label", "long"), ("n", "long"), ("bits", "binary"))],
    )

    def compared(docs: list[dict], shared: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The close ones among the pairs that ``shared`` marks, by their places in ``docs``."""
        keys, labels, sizes = (np.array([d[c] for d in docs], np.int64) for c in ("key", "label", "n"))
        sketches = [np.frombuffer(d["bits"], np.uint8) for d in docs]
        least = min(map(len, sketches))
        folded = np.array([np.bitwise_xor.reduce(s.reshape(-1, least), axis=0) for s in sketches])
        folded = folded.view(np.uint64)
        found = []
        for x in np.flatnonzero(shared.any(axis=1)):
            y = np.flatnonzero(shared[x] & (labels != labels[x]) & (keys != keys[x]))
            most = allowed(sizes[x], sizes[y])
            y, most = y[most >= 0], most[most >= 0]
            y = y[np.bitwise_count(folded[y] ^ folded[x]).sum(axis=1) <= most]
            found += [(keys[x], keys[z]) for z in y]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        pairs = np.unique(np.sort(pairs, axis=1), axis=0)
        columns = [pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by tile, a tile's documents first, then its signatures one by one."""
        tile_of = sig = None
        docs: list[dict] = []
        place: dict[int, int] = {}
        together: tuple[list[int], list[int]] = [], []
        shared = np.zeros((0, 0), bool)

        def mark() -> None:
            """Those of tile i meet those of tile j; within one tile all meet."""
            left, right = together
            if left or right:
                shared[np.ix_(left or right, right or left)] = True

        for batch in sliced(batches, 4_096):
            for row in batch.to_pylist():
                at = row["pivot"], row["i"], row["j"]
                if at != tile_of:
                    mark()
                    if shared.any():
                        yield from compared(docs, shared)
                    tile_of, sig, docs, place, together = at, None, [], {}, ([], [])
                    shared = np.zeros((0, 0), bool)
                if row["sig"] is None:
                    place[row["key"]] = len(docs)
                    docs.append(row)
                    continue
                if not len(shared):
                    shared = np.zeros((len(docs), len(docs)), bool)
                if row["sig"] != sig:
                    mark()
                    sig, together = row["sig"], ([], [])
                together[int(row["own"] == row["j"])].append(place[row["key"]])
        mark()
        if shared.any():
            yield from compared(docs, shared)

    order = ["pivot", "i", "j", "sig", "key"]
    rows = documents.unionByName(having).repartition("pivot", "i", "j").sortWithinPartitions(*order)
    return rows.mapInArrow(made, _PAIR)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    run: int = RUN,
    tile: int = TILE,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row: the size of its set of word
    shingles, and the smallest id reachable over links, its own included.

    Null texts and texts without words have no shingles and are linked with nothing. Rows of equal
    sets are one node of the graph, named by a 64-bit hash of the set, however many there are. Rows
    with the same id count as they are: each by its own text. A row without an id has the id of its
    class or none. No rows give no rows; other columns are not read. Texts are used whole.
    """
    texts = _texts(docs, id_column, text_column)
    sets = written(_sets(texts), "sets")
    rows = sets.where(F.col("chunk").isNull())
    counters = _counters(sets.where(F.col("chunk").isNotNull()))
    nodes = written(
        rows.where(F.col("n") > 0)
        .groupBy("key", "n")
        .agg(F.min("doc_id").alias("doc_id"), F.min("bits").alias("bits")),
        "nodes",
    )
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = docs.sparkSession.sparkContext.broadcast(counters)
    met = written(_meetings(_sent(texts, shared, partitions), run), "meetings")
    # Workers live on after a job, and would keep it.
    shared.destroy()
    pairs = met.where(F.col("sig").isNull()).select("a", "b").distinct()
    edges = written(_verified(_near(pairs, nodes), texts), "edges")
    members = met.where(F.col("sig").isNotNull()).select("sig", F.col("a").alias("key"))
    mapping = contract_to_stars(edges).mapping
    if not members.isEmpty():
        apart = _left_apart(members, nodes, mapping, tile).distinct().join(pairs, ["a", "b"], "left_anti")
        more = written(_verified(_near(apart, nodes), texts), "edges")
        if not more.isEmpty():
            mapping = contract_to_stars(edges.unionByName(more)).mapping
    labels = mapping.select(F.col("txId").alias("key"), F.col("resolvedEntityId").alias("label"))
    placed = nodes.select("key", "doc_id").join(labels, "key", "left").select(
        "key", "doc_id", F.coalesce("label", "key").alias("label")
    )
    named = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    classes = placed.join(named, "label").select("key", "component_id")
    full = rows.where(F.col("n") > 0).join(classes, "key", "left")
    alone = rows.where(F.col("n") == 0).withColumn("component_id", F.col("doc_id"))
    columns = [F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), "component_id"]
    return full.select(*columns).unionByName(alone.select(*columns))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each class of near duplicates, that with the smallest id. Rows
    without an id or without words all stay. Where ids repeat, one row of an id and text stays, and
    an id that stands for a class keeps its other texts, too. No rows give no rows; other columns may
    have any name."""
    found = near_duplicates(docs, id_column, text_column)
    named = found.where(F.col("component_id") == F.col(id_column)).select(F.col(id_column).alias("_kept"))
    kept = written(named.groupBy("_kept").agg(F.count("*").alias("_rows")), "kept")
    ids = kept.select("_kept")
    if kept.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    aside, back = set_aside(docs, {"_kept"})
    staying = aside.join(ids, F.col(id_column) == F.col("_kept"), "left_semi").withColumnsRenamed(back)
    if not kept.where(F.col("_rows") > 1).isEmpty():
        staying = staying.dropDuplicates([id_column, text_column])
    return staying.unionByName(docs.where(F.col(id_column).isNull()))
