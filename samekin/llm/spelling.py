"""Grouping of spelling variants by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Of such
a pair let L be the length of the longer word. The words agree before and after the edit, so if the
places 0 to L - 1 are cut into windows, they agree everywhere outside the window that holds the edit.
Words of length L and L - 1 that agree outside a window are a block. Blocks start with the two halves
of a word; a block of more than ``CROWDED`` rows is cut into those of the two halves of its window, and
a window of one place leaves no more words than there are letters. So every block is small whatever
the words look like, and none is left out.

The words of a block are a matrix of code points, padded to L once on the right and once on the left.
All its rows are compared with each other, many blocks of like size at a time: the common prefix plus
the common suffix reaches L - 1 for single edits and for nothing else. A pair counts in the window its
common prefix ends in, which is one, so no pair has to be deduplicated and none leaves a task: a block
gives each word the number of its near words there and the best of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samekin.llm.store import written
from samekin.llm.text import LOWER_ASCII, sliced

# Fixed values of the contract: what a word is, and which occurrences lose a letter.
LETTERS = r"[a-zÀ-ÿ]"
MISSPELT_EVERY = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
# A near word has to be so many times as frequent to be the form of a word.
TIMES = 5

# Rows of a block that are compared with each other; larger blocks are cut further.
CROWDED = 512
# Words counted by a task before the counts go out.
COUNTED_TOGETHER = 1 << 18
# Rows compared together, and comparisons held at once.
ROWS_TOGETHER = 1 << 16
CELLS_TOGETHER = 1 << 21

BLOCK = ["size", "low", "high", "key"]


def word_counts(
    docs: DataFrame, id_column: str, text_column: str, every: int, least_length: int
) -> DataFrame:
    """``word``, ``n``: what the tasks counted, not yet added up."""
    run = re.compile(f"{LETTERS}{{{least_length},}}")
    lower = LOWER_ASCII.tobytes()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(list(tally), pa.string()), "n": pa.array(list(tally.values()), pa.int64())}
            )

        for batch in sliced(batches):
            for name, text in zip(batch["_id"].to_pylist(), batch["_text"].to_pylist()):
                if not text:
                    continue
                seed = zlib.crc32(f"{name or ''}:".encode())
                # The same run of the same document has the same hash.
                for word, n in Counter(run.findall(text.encode().translate(lower).decode())).items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    tally[word] += n
                if len(tally) >= COUNTED_TOGETHER:
                    yield flushed()
                    tally.clear()
        if tally:
            yield flushed()

    return docs.select(
        F.col(id_column).cast("string").alias("_id"), F.col(text_column).alias("_text")
    ).mapInArrow(counted, "word string, n long")


def _in_windows(rows: DataFrame, windows: Column) -> DataFrame:
    """``rows`` (word, n, size) once for each of ``windows``, with the key of what lies outside."""
    length = F.length("word")
    cut = rows.withColumn("_window", F.explode(windows)).select(
        "word", "n", "size", F.col("_window.low").alias("low"), F.col("_window.high").alias("high")
    )
    before = F.substring(F.col("word"), F.lit(1), F.col("low"))
    # Counted from the end, so that the shorter words stand one place to the left.
    after = F.col("size") - F.col("high")
    behind = F.when(after > 0, F.substring(F.col("word"), length - after + 1, after)).otherwise("")
    return cut.withColumn("key", F.xxhash64(before, behind))


def _halves(low: Column, high: Column) -> Column:
    middle = F.floor((low + high) / 2).cast("int")
    return F.array(
        F.struct(low.alias("low"), middle.alias("high")), F.struct(middle.alias("low"), high.alias("high"))
    )


def blocks(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """``word``, ``n``, ``size`` (L), ``low``, ``high`` (the window) and ``key``: every word once in the
    classes L of its own length and of the next, and there once in each window."""
    length = F.length("word")
    sizes = F.explode(F.array(length, length + 1)).alias("size")
    level = _in_windows(words.select("word", "n", sizes), _halves(F.lit(0), F.col("size")))
    parts = []
    while True:
        large = written(
            level.where(F.col("high") - F.col("low") > 1)
            .groupBy(*BLOCK)
            .agg(F.count("*").alias("_rows"))
            .where(F.col("_rows") > crowded)
            .select(*BLOCK),
            "crowded",
        )
        if large.isEmpty():
            parts.append(level)
            break
        parts.append(level.join(large, BLOCK, "left_anti"))
        again = level.join(large, BLOCK, "left_semi")
        # The halves of a window are told apart, so no word meets another twice.
        level = written(_in_windows(again, _halves(F.col("low"), F.col("high"))), "windows")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def _matrix(words: list[bytes], size: int, right: bool) -> np.ndarray:
    """Code points, all below 256, of words of ``size`` or one less, padded to ``size``."""
    padded = [w.rjust(size, b"\0") if right else w.ljust(size, b"\0") for w in words]
    return np.frombuffer(b"".join(padded), np.uint8).reshape(len(words), size)


def _common(matrix: np.ndarray, columns: range) -> np.ndarray:
    """How many of ``columns``, taken in this order, agree before the first that does not: for any two
    rows of each block of ``matrix`` (blocks, rows, columns)."""
    n, rows, _ = matrix.shape
    length = np.zeros((n, rows, rows), np.uint16 if len(columns) < 1 << 16 else np.uint32)
    alive = np.ones((n, rows, rows), bool)
    for c in columns:
        alive &= matrix[:, :, None, c] == matrix[:, None, :, c]
        if not alive.any():
            break
        length += alive
    return length


def near_rows(
    words: list[bytes], block: np.ndarray, size: int, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (i, j), both ways, whose words are near: rows of one ``block`` (ascending numbers)
    that differ in its window ``low`` to ``high``."""
    first = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
    rows = np.diff(first, append=len(block))
    longer = np.fromiter((len(w) == size for w in words), bool, len(words))
    left, right = _matrix(words, size, False), _matrix(words, size, True)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    padded = 1 << np.ceil(np.log2(np.maximum(rows, 1))).astype(np.int64)
    for width in np.unique(padded[rows > 1]):
        chosen = np.flatnonzero((padded == width) & (rows > 1))
        together = max(1, CELLS_TOGETHER // int(width * width))
        for start in range(0, len(chosen), together):
            part = chosen[start : start + together]
            within = np.arange(width)
            real = within[None, :] < rows[part][:, None]
            at = first[part][:, None] + np.where(real, within[None, :], 0)
            prefix = _common(left[at], range(size))
            suffix = _common(right[at], range(size - 1, -1, -1))
            edit = np.minimum(prefix, size - 1)
            near = prefix.astype(np.int64) + suffix >= size - 1
            near &= (edit >= low[at[:, :1]][:, :, None]) & (edit < high[at[:, :1]][:, :, None])
            # Words that are both one shorter are of another class.
            near &= longer[at][:, :, None] | longer[at][:, None, :]
            near &= real[:, :, None] & real[:, None, :] & ~np.eye(width, dtype=bool)
            b, i, j = np.nonzero(near)
            found.append((at[b, i], at[b, j]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _neighbours(placed: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``form_n``, ``form``: how many near words a block holds, and the most
    frequent of them (ties: the smallest). The rows of a partition stream through sorted by block."""

    def compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Of whole blocks."""
        size, low, high, key = (table[c].to_numpy() for c in BLOCK)
        new = np.zeros(len(size), bool)
        new[1:] = (np.diff(size) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0) | (key[1:] != key[:-1])
        number = np.cumsum(new)
        counts = table["n"].to_numpy()
        words = [w.encode("latin-1") for w in table["word"].to_pylist()]
        for value in np.unique(size):
            own = np.flatnonzero(size == value)
            # Whole blocks, fewer rows at once if the words are long.
            together = max(1, ROWS_TOGETHER // max(1, int(value) // 16))
            starts = np.flatnonzero(np.diff(number[own], prepend=-1))
            cuts = starts[np.flatnonzero(np.diff(starts // together, prepend=-1))]
            for part in np.split(own, cuts[1:]):
                held = [words[i] for i in part]
                i, j = near_rows(held, number[part], int(value), low[part], high[part])
                if len(i):
                    yield best(held, counts[part], i, j)

    def best(words: list[bytes], counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        # Rows of a block ascend by word.
        order = np.lexsort((j, -counts[j], i))
        i, j = i[order], j[order]
        first = np.flatnonzero(np.diff(i, prepend=-1))
        return pa.RecordBatch.from_pydict(
            {
                "word": pa.array([words[x].decode("latin-1") for x in i[first]], pa.string()),
                "n_near": pa.array(np.diff(first, append=len(i)), pa.int64()),
                "form_n": pa.array(counts[j[first]], pa.int64()),
                "form": pa.array([words[x].decode("latin-1") for x in j[first]], pa.string()),
            }
        )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < ROWS_TOGETHER:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = np.ones(len(table), bool)
            for c in BLOCK:
                values = table[c].to_numpy()
                last &= values == values[-1]
            # The last block may go on.
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                yield from compared(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            rows = len(table) - cut
        if rows:
            yield from compared(pa.Table.from_batches(held).combine_chunks())

    dealt = placed.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "word")
    return dealt.select("word", "n", *BLOCK).mapInArrow(
        made, "word string, n_near long, form_n long, form string"
    )


def _with_roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for the rows (``word``, ``form``): the end of the chain of forms. Each round
    doubles the steps taken; a form is ``TIMES`` as frequent as its word, so chains are short."""
    reached = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    reached = written(reached, "roots")
    while not reached.where("moved").isEmpty():
        ends = reached.select(F.col("word").alias("root"), F.col("root").alias("_end"))
        reached = written(
            reached.join(ends, "root", "left").select(
                "word", F.coalesce("_end", "root").alias("root"), F.col("_end").isNotNull().alias("moved")
            ),
            "roots",
        )
    return reached.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    every: int = MISSPELT_EVERY,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    crowded: int = CROWDED,
) -> DataFrame:
    """A row for each word: ``word``, ``n`` (occurrences), ``n_near`` (its near words), ``form`` (the near
    word of largest n, ties to the smallest, if that n is ``times`` the word's; else null), ``form_n``
    and ``root`` (the last of the chain of forms; the word itself if it has none).

    Words are the maximal runs of ``LETTERS`` after A-Z were lower-cased, of whole texts. An occurrence
    whose CRC-32 of ``<id>:<run>`` is divisible by ``every`` loses the letter at that number modulo its
    length. Results of at least ``least_length`` letters and ``least_count`` occurrences are words.

    Null and empty texts have none. A row without an id has the empty id. Repeated rows count as often
    as they are. No rows give no rows; other columns are not read. Words may have any length.
    """
    counted = word_counts(docs, id_column, text_column, every, least_length)
    words = written(
        counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count), "words"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    near = written(
        _neighbours(blocks(words, crowded))
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best")),
        "near",
    )
    known = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-F.col("best.less")).alias("_n"),
        F.col("best.form").alias("_form"),
    )
    frequent = F.col("_n") >= times * F.col("n")
    formed = written(
        known.select(
            "word",
            "n",
            "n_near",
            F.when(frequent, F.col("_form")).alias("form"),
            F.when(frequent, F.col("_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _with_roots(formed.where(F.col("form").isNotNull()).select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
