"""Log probabilities of whole documents under a recurrent model and a smoothed unigram."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import remainder, table, whole_text
from dockwise.llm.gru import LANES, PER_CLASS, WINDOW, Lanes, Model, Shape
from dockwise.session import settle

#: Words that every task knows by heart, each with its own input and its own leaf or place in the
#: recurrent model; counts of all others, which are one class, are joined. A bound on memory.
HOT = 200_000
#: Classes of single words in the softmax; the other hot words form classes by rank, each
#: twice as wide as the one before and a binary tree, and all remaining words are the last class.
WORD_CLASSES = 16
#: Tokens that a task lays out in lanes at once when it scores.
TOKENS = 2_000_000
#: Rounds of learning, and tokens from which a task learns in one round, about.
ROUNDS, SHARD_TOKENS = 4, 2_000_000
#: Rows of weights that are averaged together; 256 at most.
PART_ROWS = 128
#: Distinct words that a task counts before it hands them on.
DISTINCT = 400_000
#: The end of a document; no word is empty.
END = ""


def words_of(text: str) -> list[bytes]:
    """Lower-cased words of a text, then its end."""
    return [*text.encode("utf-8", "replace").lower().split(), b""]


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """`words_of` many texts: distinct words, the numbers of all tokens among them, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.large_string())))
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary, np.asarray(coded.indices)
    end = pc.index(words, END).as_py()
    if end < 0:
        end, words = len(words), pa.concat_arrays([words, pa.array([END], words.type)])
    # white space at the borders of a text leaves empty words, which are dropped for one end
    real = codes != end
    upto = np.concatenate([[0], np.cumsum(real)])
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists))])
    n = np.diff(upto[ends])
    flat = np.full(int(n.sum()) + len(n), end, dtype=np.int32)
    word = np.ones(len(flat), dtype=bool)
    word[np.cumsum(n + 1) - 1] = False
    flat[word] = codes[real]
    return words, flat, n + 1


def count_tokens(texts: DataFrame) -> DataFrame:
    """Rows (word, c) over all rows of texts(text); the end is the empty word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.table({"word": pa.array([], pa.large_string()), "c": pa.array([], pa.int64())})
        for batch in batches:
            words, flat, _ = split(batch.column(0))
            c = np.bincount(flat, minlength=len(words))
            here = np.flatnonzero(c)
            new = pa.table({"word": words.take(pa.array(here)), "c": pa.array(c[here])})
            held = pa.concat_tables([held, new]).group_by("word").aggregate([("c", "sum")]).rename_columns(["word", "c"])
            if len(held) > DISTINCT:
                yield from rows(held)
                held = held.slice(0, 0)
        yield from rows(held)

    def rows(held: pa.Table) -> list[pa.RecordBatch]:
        return held.select(["word", "c"]).cast(pa.schema([("word", pa.string()), ("c", pa.int64())])).to_batches(50_000)

    return texts.mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """What tasks know of the hot words, by place; the place after the last is any other word."""

    place: pa.Array  # the hot words, each at its place
    end: int  # place of the end
    inputs: np.ndarray  # row of the embedding
    classes: np.ndarray  # class in the softmax
    words: np.ndarray  # place in a class of words, or rank in the trees
    base: np.ndarray  # log10(c + 1)
    class_log: np.ndarray
    word_log: np.ndarray
    count: np.ndarray  # of the hot words

    @property
    def fixed(self) -> np.ndarray:
        """log10 of shares that the model does not give: none."""
        return np.zeros(len(self.inputs))

    @property
    def shape(self) -> Shape:
        return Shape(len(self.inputs), len(self.word_log), len(self.class_log) - len(self.word_log), len(self.place))


def lexicon(hot: list[tuple[str, int]], total: int) -> Lexicon:
    """Classes of the hot words, given by falling count, and their frequencies as a start.

    Every hot word has an input and a place in its class of its own: in a softmax, or by its
    rank in the tree of its band.
    """
    n, single = len(hot), WORD_CLASSES * PER_CLASS  # a power of two, as the bands of `Shape` are
    count = np.array([c for _, c in hot], dtype=np.float64)
    rank = np.arange(n)
    band = np.where(rank < single, 0, np.floor(np.log2(np.maximum(rank, single) / single)).astype(int))
    bands = int(band[single:].max(initial=-1)) + 1
    classes = np.where(rank < single, rank // PER_CLASS, WORD_CLASSES + band)
    mass = np.bincount(classes, weights=count, minlength=WORD_CLASSES + bands)
    rest = WORD_CLASSES + bands  # the class of all other words
    mass = np.append(mass, max(0.0, total - count.sum())) + 0.5
    word_log = np.full((WORD_CLASSES, PER_CLASS), -30.0)
    top = min(n, single)
    word_log.reshape(-1)[:top] = np.log(count[:top] / mass[classes[:top]])
    return Lexicon(
        pa.array([w for w, _ in hot], pa.large_string()),
        next((k for k, (w, _) in enumerate(hot) if w == END), n),
        np.arange(n + 1, dtype=np.int32),
        np.append(classes, rest).astype(np.int16),
        np.append(np.where(rank < single, rank % PER_CLASS, rank), 0).astype(np.int32),
        np.append(np.log10(count + 1), 0.0),
        np.log(mass / mass.sum()),
        word_log,
        count,
    )


class Tokens:
    """Flat token arrays of some documents in the order of lanes."""

    def __init__(self, known: Lexicon, places: list[np.ndarray], lanes: int = LANES):
        self.lanes = Lanes([len(p) for p in places], lanes)
        self.flat = np.concatenate([places[d] for d in self.lanes.order])
        self.sizes = np.array([len(places[d]) for d in self.lanes.order])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.classes, self.words = known.classes[self.flat], known.words[self.flat]
        # each token is guessed from the one before; a document begins after an end
        end = known.inputs[known.end]
        self.inputs = np.empty(len(self.flat), dtype=np.int32)
        self.inputs[1:] = known.inputs[self.flat[:-1]]
        self.inputs[self.starts] = end
        self.keep = np.ones(len(self.flat), dtype=np.float32)
        self.keep[self.starts] = 0


ENCODED = (
    "row long, id string, learn boolean, place_of long, places binary, n_tokens long, n_hot long, hot_base double, "
    "rare_words array<string>, rare_n array<int>"
)


def encode(rows: DataFrame, known: Broadcast) -> DataFrame:
    """Rows (row, id, learn, text) with the places of their tokens, looked up once, in place of the text.

    n_hot and hot_base are sums over the hot tokens; all other words are listed with how
    often they occur. place_of is a hash of id and tokens, by which shards are dealt.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                yield coded(lex, batch.slice(at, 2048))

    def coded(lex: Lexicon, batch: pa.RecordBatch) -> pa.RecordBatch:
        words, flat, n = split(batch.column("text"))
        other = len(lex.place)
        place = np.asarray(pc.fill_null(pc.index_in(words, value_set=lex.place), other)).astype(np.int32)
        found, ends = place[flat], np.concatenate([[0], np.cumsum(n)])
        # a row for each text and rare word in it, texts in order
        rare = np.flatnonzero(found == other)
        text_of = np.repeat(np.arange(len(n)), n)[rare]
        pairs, times = np.unique(text_of * len(words) + flat[rare], return_counts=True)
        own = np.searchsorted(pairs, np.arange(len(n) + 1) * len(words)).astype(np.int32)
        rare_words = words.take(pa.array(pairs % max(1, len(words)))).cast(pa.string())
        raw = found.tobytes()
        places = [raw[4 * a : 4 * b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
        marks = [
            xxhash.xxh64_intdigest(own_places, xxhash.xxh32_intdigest(str(row_id))) >> 1
            for row_id, own_places in zip(batch.column("id").to_pylist(), places)
        ]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("row"), batch.column("id"), batch.column("learn"), pa.array(marks, pa.int64()),
                pa.array(places, pa.binary()), pa.array(n), pa.array(n - np.bincount(text_of, minlength=len(n))),
                pa.array(np.add.reduceat(lex.base[found], ends[:-1])),
                pa.ListArray.from_arrays(pa.array(own), rare_words), pa.ListArray.from_arrays(pa.array(own), pa.array(times.astype(np.int32))),
            ],
            names=[part.split(" ")[0] for part in ENCODED.split(", ")],
        )

    return rows.mapInArrow(look, ENCODED)


def matrices(shape: Shape, flat: np.ndarray) -> list[np.ndarray]:
    """Weights as views by kind: a row for each dense weight, rows of inputs, rows of nodes."""
    parts = shape.views(flat)
    return [flat[: shape.dense, None], parts["E"], parts["T"]]


def moved(shape: Shape, old: np.ndarray, new: np.ndarray, count: int) -> Iterator[list[tuple]]:
    """Rows (part, at, w, n): by how much a shard of n tokens moved the rows of a part of the weights that it touched.

    A part is PART_ROWS rows of a matrix. Moves of inputs and nodes travel in half precision.
    """
    for kind, (a, b) in enumerate(zip(matrices(shape, old), matrices(shape, new))):
        touched = np.flatnonzero((a != b).any(axis=1)) if a.size else np.zeros(0, dtype=np.int64)
        steps = (b[touched] - a[touched]).astype(np.float16 if kind else np.float32)
        part, at = np.divmod(touched, PART_ROWS)
        begins = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
        at = at.astype(np.uint8)
        yield [
            (kind << 24 | int(part[i]), at[i:j].tobytes(), steps[i:j].tobytes(), count)
            for i, j in zip(begins, [*begins[1:], len(part)])
        ]


def average(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Means by tokens of the moves of each row, over the shards that touched it; rows come sorted by part."""
    own, sums, mass = None, None, None

    def mean() -> pd.DataFrame:
        at = np.flatnonzero(mass)
        w = (sums[at] / mass[at, None]).astype(np.float32)
        return pd.DataFrame([(own, at.astype(np.uint8).tobytes(), w.tobytes())], columns=["part", "at", "w"])

    for batch in batches:
        for part, at, w, n in batch.itertuples(index=False):
            at = np.frombuffer(at, dtype=np.uint8)
            w = np.frombuffer(w, dtype=np.float16 if part >> 24 else np.float32).reshape(len(at), -1)
            if part != own:
                if own is not None:
                    yield mean()
                own, sums, mass = part, np.zeros((PART_ROWS, w.shape[1])), np.zeros(PART_ROWS)
            sums[at] += w.astype(np.float64) * n
            mass[at] += n
    if own is not None:
        yield mean()


def train(encoded: DataFrame, known: Broadcast, tokens: int, rounds: int = ROUNDS) -> np.ndarray:
    """Weights learned from all encoded rows that are to be learned from, `tokens` tokens in all.

    A hash of the row deals the rows to shards of about SHARD_TOKENS tokens, and these to
    rounds; in a shard rows follow each other in the order of the hash. So neither the
    layout of the files nor the cluster decides what a shard holds. In a round every shard
    is learned from alone, all from the same start; the moves of the weights are then averaged
    by tokens over the shards that touched them, part by part of the weights, and the next
    round starts from the average. Every
    row is read once. Documents lie in lanes, windows follow each other with the state
    carried on, and backpropagation is cut at their starts.
    """
    shards = max(1, round(tokens / SHARD_TOKENS / rounds))
    context, lex = encoded.sparkSession.sparkContext, known.value
    weights = lex.shape.start(lex.class_log, lex.word_log, lex.count)
    rows = encoded.filter("learn").select("place_of", "places", F.expr(f"place_of % {rounds * shards}").alias("shard"))
    for number in range(rounds):
        start = context.broadcast(weights)

        def learn(batches: Iterator[pd.DataFrame], start=start, number=number) -> Iterator[pd.DataFrame]:
            shard, held = None, []
            for batch in batches:
                for own, raw in zip(batch["shard"], batch["places"]):
                    if own != shard:
                        if held:
                            yield learned(held, start.value, number)
                        shard, held = own, []
                    held.append(np.frombuffer(raw, dtype=np.int32))
            if held:
                yield learned(held, start.value, number)

        def learned(places: list[np.ndarray], weights: np.ndarray, number: int) -> pd.DataFrame:
            lex = known.value
            model = Model(lex.shape, weights, 1 / (1 + number))
            count = sum(map(len, places))
            part = Tokens(lex, places, max(32, min(LANES, count // (64 * WINDOW))))
            model.learn(part.lanes, part.inputs, part.keep, part.classes, part.words)
            return pd.concat([pd.DataFrame(part, columns=["part", "at", "w", "n"]) for part in moved(lex.shape, weights, model.flat, count)])

        mine = rows.filter(F.col("shard") % rounds == number)
        dealt = mine.repartition(shards, "shard").sortWithinPartitions("shard", "place_of", "places")
        parts = dealt.mapInPandas(learn, "part int, at binary, w binary, n long")
        means = parts.repartition("part").sortWithinPartitions("part", "n", "at", "w").mapInPandas(average, "part int, at binary, w binary")
        for part, at, w in means.toPandas().itertuples(index=False):  # as large as the weights, whose number is bounded
            step = np.frombuffer(w, dtype=np.float32)
            at = np.frombuffer(at, dtype=np.uint8).astype(np.int64)
            matrix = matrices(lex.shape, weights)[part >> 24]
            matrix[((part & 0xFFFFFF) * PART_ROWS) + at] += step.reshape(len(at), -1)
        start.unpersist()
    return weights


def score_hot(encoded: DataFrame, known: Broadcast, weights: Broadcast) -> DataFrame:
    """Rows (row, id, n_tokens, n_hot, hot_base, hot_score): log10 of what the model gives to the hot tokens and classes."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = known.value
        model = Model(lex.shape, weights.value)
        held, size = [], 0

        def flush() -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            tokens = Tokens(lex, [np.frombuffer(raw, dtype=np.int32) for raw in rows["places"]])
            logs = model.score(tokens.lanes, tokens.inputs, tokens.keep, tokens.classes, tokens.words) / math.log(10)
            rows = rows.drop(columns="places").iloc[tokens.lanes.order]
            return rows.assign(hot_score=np.add.reduceat(logs, tokens.starts))

        for batch in batches:
            for at in range(0, len(batch), 256):
                held.append(batch.iloc[at : at + 256])
                size += int(held[-1]["n_tokens"].sum())
                if size >= TOKENS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    columns = encoded.select("row", "id", "n_tokens", "n_hot", "hot_base", "places")
    return columns.mapInPandas(score, "row long, id string, n_tokens long, n_hot long, hot_base double, hot_score double")


def lm_scores(docs: DataFrame, learn_from, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the whole text (runs without ASCII white space, A-Z in lower
    case) and one end. learn_from is a column that is true for the rows to learn from; null
    is false. base_score is the sum of log10((c + 1) / (N + V + 1)) over the tokens, c being
    the token's count, N all tokens and V the distinct ones in the rows learned from;
    n_known counts tokens with c > 0. score is log10 of the probability of the text under a
    gated recurrent model: the softmax gives a class, then a softmax the word in its class; in
    classes of rarer words the state decides turn by turn on the way down a binary tree to the
    word; the last class, of all words
    beyond `hot`, by (c + 1) / (tokens + distinct words + 1) of that class, so that words
    never seen keep a probability. The state runs through the whole document.

    A null text is empty and has the end alone; repeated rows and null ids are scored like
    any; with nothing to learn from, base_score is that of N = V = 0; an empty table gives
    an empty result. Counts and training cover every row to learn from.

    At scale the counts, which grow with the input, stay distributed: tasks know at most
    `hot` words; all others are looked up by a join, each at most once per document. Scores
    do not depend on how many files or tasks there are, but for the last digits.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), whole_text(text_col).alias("text"), F.coalesce(learn_from, F.lit(False)).alias("learn")
    )
    learned = rows.filter("learn").select("text")
    band = F.floor(F.log2("c") * 64).cast("int")
    counts = settle(count_tokens(learned).withColumn("band", band))
    sizes = sorted(
        (
            (r["band"], r["types"], r["tokens"])
            for r in counts.groupBy("band").agg(F.count("*").alias("types"), F.sum("c").alias("tokens")).collect()
        ),  # one row for each 1/64 of a doubling of the count
        reverse=True,
    )
    total, distinct = sum(s[2] for s in sizes), sum(s[1] for s in sizes)
    least, hot_types, hot_tokens = 1 << 20, 0, 0
    for number, types, tokens in sizes:
        if hot_types + types > hot or number < 64:  # words seen once stand for those never seen
            break
        least, hot_types, hot_tokens = number, hot_types + types, hot_tokens + tokens
    chosen = [(r["word"], r["c"]) for r in counts.filter(F.col("band") >= least).select("word", "c").collect()]  # <= hot
    chosen.sort(key=lambda wc: (-wc[1], wc[0]))
    context = docs.sparkSession.sparkContext
    known = context.broadcast(lexicon(chosen, total))
    # written: the numbers of the rows stay, and the tokens are looked up once
    encoded = settle(encode(rows.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("string"), "learn", "text"), known))
    weights = context.broadcast(train(encoded, known, total))

    scored = score_hot(encoded, known, weights)
    tail = counts.filter(F.col("band") < least).select("word", "c")
    rare = encoded.select("row", F.explode(F.arrays_zip("rare_words", "rare_n")).alias("r"))
    rare = rare.select("row", F.col("r.rare_words").alias("word"), F.col("r.rare_n").alias("n")).join(tail, "word", "left")
    sums = rare.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)).alias("rare_log"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
    )
    rare_log, rare_known = F.coalesce("rare_log", F.lit(0.0)), F.coalesce("rare_known", F.lit(0))
    in_rest = math.log10(total - hot_tokens + distinct - hot_types + 1)
    return scored.join(sums, "row", "left").select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col),
        "n_tokens",
        (F.col("n_hot") + rare_known).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("hot_base") + rare_log - F.col("n_tokens") * F.lit(math.log10(total + distinct + 1))).alias("base_score"),
        (F.col("hot_score") + rare_log - (F.col("n_tokens") - F.col("n_hot")) * F.lit(in_rest)).alias("score"),
    )


def held_out(id_col: str = "doc_id"):
    """Rows that the model does not learn from; a null id counts as held out."""
    return F.coalesce(remainder(id_col, 7) == 2, F.lit(True))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = lm_scores(docs, ~held_out())
    return scores.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


QUERIES = {"op10_lm": op10_lm}
