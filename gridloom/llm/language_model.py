"""Scores of whole texts by a smoothed word model and by a self-attention model, both learned from the corpus.

Word counts: each task counts its texts, Spark adds the counts up. Words that are frequent enough to be among the first
`FREQUENT_WORDS` are sent to every task, a table that this number bounds; each other word of a text
is joined with the whole table of counts, so no word is left out and none goes to the driver.

Attention model: ids are made once and stored. Their counts over all training texts shape the model's tree and its
odds. Every window of every training text is a step of one of the rounds, drawn by hash. In each round every task starts from
the same parameters and takes steps on the round's windows of its texts; the moves are averaged, each parameter weighted by the gradients it has seen. Blocks of parameters
are added up by Spark, so that what a task or the driver holds is the size of one model.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.attention import Model, Shape, rows_of_texts
from gridloom.llm.common import as_bytes, written
from gridloom.llm.tokens import default_path, encoded, encoder
from gridloom.session import fresh_path

#: Bounds of the word table that every task gets: words, and bytes of a word; every other word is joined.
FREQUENT_WORDS = 200_000
LONGEST_SENT = 64
#: Rounds that share the windows of all training texts among them.
ROUNDS = 2
#: Distinct words that a counting task holds before it passes them on.
HELD_WORDS = 250_000
BLOCK = 512
#: Texts that are encoded together.
ROWS_AT_ONCE = 1500
#: Words that are looked up together.
WORDS_AT_ONCE = 1 << 18
#: Ids that are scored together.
IDS_AT_ONCE = 1 << 18
END_WORD = b""


def is_held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words and the end."""
    words = text.lower().split()
    words.append(END_WORD)
    return words


def _text_sum(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over the texts of the training rows (held, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                held.update(words_of(text.as_py()))
                if len(held) >= HELD_WORDS:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    counts = rows.where(~F.col("held")).select("text").mapInArrow(run, "word binary, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])


def frequent_words(counts: DataFrame, most: int) -> tuple[dict[bytes, int], np.ndarray]:
    """Places of the words of the highest counts, down to a count at which they are at most `most`, and their counts.

    Words of more than `LONGEST_SENT` bytes are not among them.
    """
    counts = counts.where(F.octet_length("word") <= LONGEST_SENT)
    band = F.floor(F.log2("n") * 8)
    bands = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
    least, total = None, 0
    for row in sorted(bands.collect(), key=lambda r: -r.band):  # some hundred bands at most
        total += row.words
        if total > most:
            break
        least = row.least
    if least is None:
        return {}, np.zeros(0, np.int64)
    found = counts.where(F.col("n") >= least).toArrow()
    return {word: i for i, word in enumerate(found.column(0).to_pylist())}, found.column(1).to_numpy()


def base_scores(rows: DataFrame, counts: DataFrame, most_frequent: int = FREQUENT_WORDS) -> tuple[DataFrame, int]:
    """(key, sum, held, n_tokens, n_known, base_score, copies) by distinct (key, text), and the training tokens."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    scale = total + 0.5 * (distinct + 1)
    table = rows.sparkSession.sparkContext.broadcast(frequent_words(counts, most_frequent))
    key_type = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, n = table.value
        value = np.r_[np.log10((n + 0.5) / scale), 0.0]
        for batch in batches:
            keys, texts = batch.column(0), batch.column(2)
            at = 0
            while at < batch.num_rows:
                words, ends = [], []
                sums = []
                start = at
                while at < batch.num_rows and (at == start or len(words) < WORDS_AT_ONCE):
                    text = texts[at].as_py()
                    words += words_of(text)
                    ends.append(len(words))
                    sums.append(_text_sum(text))
                    at += 1
                begin = np.r_[0, ends[:-1]]
                place = np.fromiter(map(places.get, words, repeat(-1)), np.int64, len(words))
                seen = np.add.reduceat((place >= 0).astype(np.int64), begin)
                score = np.add.reduceat(value[place], begin)
                mine, sums = keys.slice(start, at - start), pa.array(sums, pa.int64())
                held = batch.column(1).slice(start, at - start)
                yield pa.RecordBatch.from_arrays([mine, sums, held, pa.array(np.diff(np.r_[0, ends])), pa.array(seen), pa.array(score), pa.nulls(len(mine), pa.binary())], names)
                other = np.flatnonzero(place < 0)
                if len(other):
                    of = pa.array(np.searchsorted(ends, other, "right"))
                    none = [pa.nulls(len(other), kind) for kind in kinds[2:6]]
                    yield pa.RecordBatch.from_arrays([mine.take(of), sums.take(of), *none, pa.array([words[i] for i in other.tolist()], pa.binary())], names)

    names = ["key", "sum", "held", "n_tokens", "n_known", "base_score", "word"]
    schema = f"key {key_type}, sum long, held boolean, n_tokens long, n_known long, base_score double, word binary"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = [field.type for field in to_arrow_schema(StructType.fromDDL(schema))]
    parts = written(rows.mapInArrow(run, schema), "word-scores")
    rare = parts.where(F.col("word").isNotNull()).join(counts.withColumnRenamed("word", "counted"), F.col("word") == F.col("counted"), "left")
    score = F.log10((F.coalesce("n", F.lit(0)) + 0.5) / F.lit(scale))
    looked_up = rare.select(
        "key", "sum", "held", "n_tokens", F.when(F.col("n").isNotNull(), F.lit(1)).alias("n_known"), score.alias("base_score"), F.lit(0).alias("rows")
    )
    done = parts.where(F.col("word").isNull()).select("key", "sum", "held", "n_tokens", "n_known", "base_score", F.lit(1).alias("rows"))
    sums = done.unionByName(looked_up).groupBy("key", "sum").agg(
        F.max("held").alias("held"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base_score").alias("base_score"), F.sum("rows").alias("copies")
    )
    each = sums.withColumn("n_known", (F.coalesce("n_known", F.lit(0)) / F.col("copies")).cast("long")).withColumn("base_score", F.col("base_score") / F.col("copies"))
    return each, total


def stored_ids(rows: DataFrame, path: str) -> DataFrame:
    """(key, sum, held, ids): the ids of every row, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
            raw = batch.column(2).to_pylist()
            ids = [x[:-1].tobytes() for x in encoded([t.decode("utf-8", "replace") for t in raw], path)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_text_sum(t) for t in raw], pa.int64()), batch.column(1), pa.array(ids, pa.binary())], ["key", "sum", "held", "ids"])

    made = rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, sum long, held boolean, ids binary")
    folder = fresh_path(rows.sparkSession, "subword-ids")
    made.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(made.schema).parquet(folder)


def id_counts(ids: DataFrame, path: str) -> np.ndarray:
    """Counts of all ids in training texts; the last place counts the texts. The vocabulary bounds it."""
    size, dtype = encoder(path).size, encoder(path).dtype

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype), minlength=size + 1)
            total[-1] += batch.num_rows
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    out = np.zeros(size + 1)
    for row in ids.where(~F.col("held")).select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[row.id] = row.n
    return out


def rounds_of_windows(sums: np.ndarray, first: np.ndarray, text: np.ndarray, rounds: int) -> np.ndarray:
    """The round in which each window is a training step, given the sums of the texts and `Model.windows`."""
    draw = sums.view(np.uint64)[text] + first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    draw = (draw ^ draw >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((draw >> np.uint64(33)) % np.uint64(rounds)).astype(np.int64)


def trained(ids: DataFrame, path: str, shape: Shape = Shape(), rounds: int = ROUNDS) -> Model:
    """The model after `rounds` of averaged steps, which take every window of all training texts once."""
    context = ids.sparkSession.sparkContext
    model = Model(id_counts(ids, path), shape)
    dtype, mark = encoder(path).dtype, encoder(path).size
    for round_ in range(rounds):
        start = context.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], start=start, round_=round_) -> Iterator[pa.RecordBatch]:
            own = start.value
            before = own.flat()
            own.p = own.unflattened(before.copy())
            memory = own.memory()
            for batch in batches:
                texts = [np.frombuffer(x.as_py(), dtype) for x in batch.column(1)]
                row, ends = rows_of_texts(iter(texts), mark)
                first, text = own.windows(row, ends)
                own.train(row, ends, np.flatnonzero(rounds_of_windows(np.array(batch.column(0).to_pylist(), np.int64), first, text, rounds) == round_), memory)
            seen = np.concatenate([memory[name].reshape(-1) for name in own.TABLES]) - np.float32(0.1)
            moved = (own.flat() - before) * seen
            own.p = own.unflattened(before)  # the worker keeps the broadcast model for its next task
            blocks = -(-len(seen) // BLOCK)
            cut = lambda x: pa.array([x[i * BLOCK : (i + 1) * BLOCK].astype("<f4").tobytes() for i in range(blocks)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(blocks)), cut(moved), cut(seen)], ["block", "moved", "seen"])

        steps = ids.where(~F.col("held")).select("sum", "ids").mapInArrow(run, "block long, moved binary, seen binary")
        sums = written(steps, "steps").repartition(16, "block").mapInArrow(_added, "block long, moved binary, seen binary")
        flat = model.flat()
        for row in sums.collect():  # one model in size
            moved, seen = np.frombuffer(row.moved, "<f8"), np.frombuffer(row.seen, "<f8")
            flat[row.block * BLOCK : row.block * BLOCK + len(moved)] += moved / np.maximum(seen, 1e-9)
        model.p = model.unflattened(flat)
    return model


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for block, moved, seen in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            moved, seen = (np.frombuffer(x.as_py(), "<f4").astype("<f8") for x in (moved, seen))
            if block in total:
                total[block][0] += moved
                total[block][1] += seen
            else:
                total[block] = [moved, seen]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), *(pa.array([x[i].tobytes() for x in total.values()], pa.binary()) for i in (0, 1))], ["block", "moved", "seen"]
    )


def model_scores(ids: DataFrame, model: Model, path: str) -> DataFrame:
    """(key, sum, score): log10 probability of each row's ids and the end."""
    shared = ids.sparkSession.sparkContext.broadcast(model)
    dtype, mark = encoder(path).dtype, encoder(path).size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [np.frombuffer(x.as_py(), dtype) for x in batch.column(2)]
            score, at = np.zeros(len(texts)), 0
            while at < len(texts):
                until, size = at, 0
                while until < len(texts) and (until == at or size < IDS_AT_ONCE):
                    size += len(texts[until])
                    until += 1
                row, ends = rows_of_texts(iter(texts[at:until]), mark)
                score[at:until] = np.add.reduceat(own.log_probabilities(row, ends), np.r_[0, ends[:-1]], dtype=np.float64) / math.log(10)
                at = until
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["key", "sum", "score"])

    return ids.select("key", "sum", "ids").mapInArrow(run, f"key {ids.schema['key'].dataType.simpleString()}, sum long, score double")


def scored_documents(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", shape: Shape = Shape(), most_frequent: int = FREQUENT_WORDS) -> DataFrame:
    """`key`, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    A row is held out where the CRC-32 of its key as text leaves 1 modulo 5; a null key counts as an empty text
    and trains. Null texts are empty and hold the end alone. Equal rows get equal scores and come back as often as they were
    there. Without training rows nothing is known, and the models are uniform over what they could hold. An empty
    table gives no rows; other columns are not looked at.
    """
    path = path or default_path()
    rows = docs.select(F.col(key).alias("key"), is_held_out(F.col(key)).alias("held"), as_bytes(text).alias("text"))
    counts = written(word_counts(rows), "word-counts")
    base, total = base_scores(rows, counts, most_frequent)
    ids = stored_ids(rows, path)
    scores = model_scores(ids, trained(ids, path, shape), path).groupBy("key", "sum").agg(F.min("score").alias("score"))
    scores = scores.select(F.col("key").alias("score_key"), F.col("sum").alias("score_sum"), "score")
    joined = base.join(scores, (F.col("sum") == F.col("score_sum")) & F.col("key").eqNullSafe(F.col("score_key")))
    return joined.select(
        F.col("key").alias(key), F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    ).drop("copy")
