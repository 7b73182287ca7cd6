"""Collocations: phrases scored by how much of their parts they make up, counted in weighted automata."""

from __future__ import annotations

import bisect
import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockwise.llm.common import table, whole_text
from dockwise.session import settle

#: Words of the longest phrases, occurrences a candidate needs, phrases reported for a language.
LONGEST, LEAST, TOP = 4, 30, 2000
#: A candidate goes where a longer one around it has this many hundredths of its occurrences.
INSIDE = 80
#: Bits of the filter that tells tasks which shorter phrases are frequent; a fuller one costs time, not rows.
FILTER_BITS = 1 << 26
#: Tokens that a task lays out at once; their phrases are one shard.
TOKENS = 2_000_000
#: Distinct words that a task counts before it hands them on.
DISTINCT = 400_000
#: Words of the corpus for each prefix range: the number of ranges grows with the input.
RANGE_WORDS = 1_000_000
#: The language of rows without one.
NO_LANG = "und"
#: A tab parts words, and these bytes part pieces; `.` stands for them.
PIECES = bytes.maketrans(b"\t,;:!?\n\x0b\x0c\r", b" .........")


def tokens(texts: list[str]) -> list[bytes]:
    """The words of some texts, in lower case, with `.` between pieces and texts; no word holds one."""
    line = b".".join(t.encode("utf-8", "replace") for t in texts).lower().translate(PIECES)
    return line.replace(b".", b" . ").split()


class Automaton:
    """A weighted acyclic automaton, built incrementally from phrases in ascending order.

    The path of the last phrase stays open. When the next one leaves it, the states behind
    the common prefix are closed, last first, and a state that equals an earlier one (same
    weight, same ways on) is that one. Phrases are tuples of symbols that sort.
    """

    def __init__(self):
        self.states: dict[tuple, int] = {}
        self.open = [[0]]  # weight, then symbol and state of each way on
        self.path: list = []

    def add(self, phrase: tuple, weight: int) -> None:
        same, path = 0, self.path
        for a, b in zip(path, phrase):
            if a != b:
                break
            same += 1
        self._close(same)
        for symbol in phrase[same:]:
            path.append(symbol)
            self.open.append([0])
        self.open[-1][0] += weight

    def _close(self, depth: int) -> None:
        while len(self.path) > depth:
            state = tuple(self.open.pop())
            self.open[-1] += (self.path.pop(), self.states.setdefault(state, len(self.states)))

    def done(self) -> list[tuple]:
        """All states; the last one is the start."""
        self._close(0)
        start = tuple(self.open[0])
        self.states.pop(start, None)  # the start is last, also where it equals another state
        return [*self.states, start]


def automaton(phrases) -> list[tuple]:
    """The states for (phrase, weight) pairs in ascending order."""
    found = Automaton()
    for phrase, weight in phrases:
        found.add(phrase, weight)
    return found.done()


def automaton_of(columns: list[np.ndarray], names: list[list], counts: np.ndarray) -> list[tuple]:
    """The same for ascending phrases of one length, given as places in lists of ascending symbols.

    A level's states are closed in the order of their prefixes, whole runs of ways at a
    time, from the last symbol to the first; equal states are one, as ever.
    """
    states: dict[tuple, int] = {}
    weights, of = np.unique(counts, return_inverse=True)
    state = np.array([states.setdefault((w,), len(states)) for w in weights.tolist()], dtype=np.int64)[of]
    for depth in range(len(columns) - 1, -1, -1):
        change = np.zeros(len(state), dtype=bool)
        change[:1] = True
        for column in columns[:depth]:
            change[1:] |= column[1:] != column[:-1]
        starts = np.flatnonzero(change)
        ways: list = [None] * (2 * len(state))
        labels = names[depth]
        ways[0::2] = [labels[k] for k in columns[depth].tolist()]
        ways[1::2] = state.tolist()
        edges = [*(2 * starts).tolist(), len(ways)]
        closed = [states.setdefault((0, *ways[a:b]), len(states)) for a, b in zip(edges, edges[1:])]
        state, columns = np.array(closed, dtype=np.int64), [c[starts] for c in columns[:depth]]
    return list(states)


def absorb(total: dict, states: list[tuple], state: tuple, depth: int) -> None:
    """Adds an automaton of phrases of `depth` symbols to a union, symbol by symbol, weights summed."""
    ways = zip(state[1::2], state[2::2])
    if depth == 1:
        for symbol, end in ways:
            total[symbol] = total.get(symbol, 0) + states[end][0]
        return
    for symbol, following in ways:
        below = total.get(symbol)
        if below is None:
            below = total[symbol] = {}
        absorb(below, states, states[following], depth - 1)


def survivors(total: dict, least: int, depth: int, before: tuple = ()) -> Iterator[tuple[tuple, int]]:
    """The phrases of a union that have `least` or more, in ascending order."""
    for symbol in sorted(total if depth > 1 else (s for s, w in total.items() if w >= least)):
        if depth == 1:
            yield (*before, symbol), total[symbol]
        else:
            yield from survivors(total[symbol], least, depth - 1, (*before, symbol))


def paths(states: list[tuple]) -> Iterator[tuple[tuple, int]]:
    """The phrases of an automaton and their weights, in ascending order."""
    waiting = [((), states[-1])]
    while waiting:
        phrase, state = waiting.pop()
        if state[0]:
            yield phrase, state[0]
        for at in range(len(state) - 2, 0, -2):
            waiting.append((phrase + (state[at],), states[state[at + 1]]))


def union(parts: list[list[tuple]], least: int = 1) -> list[tuple]:
    """The automaton of all phrases of some, weights summed, without those below `least`."""
    total: Counter = Counter()
    for states in parts:
        for phrase, weight in paths(states):
            total[phrase] += weight
    return automaton((p, total[p]) for p in sorted(total) if total[p] >= least)


def compose(asked: list[tuple], counts: list[tuple]) -> Iterator[tuple[tuple, int]]:
    """The phrases that both accept, with the weights of the second, by walking both at once."""
    waiting = [((), asked[-1], counts[-1])]
    while waiting:
        phrase, one, two = waiting.pop()
        if one[0] and two[0]:
            yield phrase, two[0]
        ways = dict(zip(two[1::2], two[2::2]))
        for symbol, state in zip(one[1::2], one[2::2]):
            if symbol in ways:
                waiting.append((phrase + (symbol,), asked[state], counts[ways[symbol]]))


def _pack(states: list[tuple]) -> bytes:
    return pickle.dumps(states, protocol=5)  # Spark compresses what it shuffles


def _unpack(raw: bytes) -> list[tuple]:
    return pickle.loads(raw)


# --- the filter of frequent phrases ---------------------------------------------------------

MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word)


def phrase_hash(words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases, from the hashes of their first, second, ... words."""
    found = words[0]
    for more in words[1:]:
        found = found * MIX + more
    found = found ^ (found >> np.uint64(32))
    return found * MIX


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(hashes >> np.uint64(s)) % np.uint64(bits) for s in (0, 19, 37)]


def bit_filter(frequent: DataFrame, bits: int) -> np.ndarray:
    """A filter of `bits` bits over rows (lang, phrase): 64-bit words, or-ed together on Spark."""

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            words = [[word_hash(g, w.encode()) for w in p.split(" ")] for g, p in zip(batch["lang"], batch["phrase"])]
            columns = [np.array(c, dtype=np.uint64) for c in zip(*words)]
            at = np.concatenate(_places(phrase_hash(columns), bits)).astype(np.int64)
            bit = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pd.DataFrame({"at": at >> 6, "bit": bit})

    marks = frequent.mapInPandas(mark, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bit"))
    found = np.zeros(bits // 64, dtype=np.int64)
    rows = marks.toPandas()  # one row for each 64 bits of the filter at most
    found[rows["at"]] = rows["bit"]
    return found.view(np.uint64)


def _known(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = len(words) * 64
    found = np.ones(len(hashes), dtype=bool)
    for at in _places(hashes, bits):
        found &= (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


# --- counting ------------------------------------------------------------------------------


def count_words(rows: DataFrame) -> DataFrame:
    """Rows (lang, phrase, f) for the words of rows (lang, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                seen.setdefault(lang, Counter()).update(tokens(list(texts)))
            if sum(map(len, seen.values())) > DISTINCT:
                yield from frames(seen)
                seen = {}
        yield from frames(seen)

    def frames(seen: dict[str, Counter]) -> Iterator[pd.DataFrame]:
        for lang, words in seen.items():
            words.pop(b".", None)
            found = [w.decode() for w in words]
            yield pd.DataFrame({"lang": [lang] * len(found), "phrase": found, "f": list(words.values())}, dtype=object)

    counted = rows.mapInPandas(count, "lang string, phrase string, f long")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


class Phrases:
    """Ascending phrases (lang, word, ...) as places in lists of symbols, and their counts."""

    def __init__(self, columns: list[np.ndarray], names: list[list], counts: np.ndarray):
        self.columns, self.names, self.counts = columns, names, counts

    def __len__(self) -> int:
        return len(self.counts)

    def __getitem__(self, k: int) -> tuple:
        return tuple(labels[c[k]] for labels, c in zip(self.names, self.columns))

    def states(self, a: int, b: int) -> list[tuple]:
        """The automaton of the phrases from a to b."""
        return automaton_of([c[a:b] for c in self.columns], self.names, self.counts[a:b])


def shard_phrases(texts: list[tuple[str, str]], size: int, known: np.ndarray) -> Phrases:
    """The phrases of `size` words of rows (lang, text).

    Only phrases both of whose parts without the last and the first word pass the filter
    are counted; no frequent phrase has an infrequent part.
    """
    by_lang: dict[str, list[str]] = {}
    for lang, text in texts:
        by_lang.setdefault(lang, []).append(text)
    labels: list[tuple[str, bytes]] = []
    hashes, flat = [np.zeros(1, dtype=np.uint64)], []  # place 0 is the end of a piece
    for lang, own in by_lang.items():
        place: dict[bytes, int] = {b".": 0}
        found = [place.setdefault(w, len(place)) for w in tokens(own)] + [0]
        del place[b"."]
        ids = np.array(found, dtype=np.int64)
        flat.append(np.where(ids > 0, ids + len(labels), 0))
        labels += [(lang, w) for w in place]
        hashes.append(np.array([word_hash(lang, w) for w in place], dtype=np.uint64))
    ids, hashed = np.concatenate(flat), np.concatenate(hashes)
    n = len(ids) - size + 2  # parts of size - 1 words
    none = Phrases([], [], np.zeros(0, dtype=np.int64))
    if n < 2:
        return none
    inner = np.ones(n, dtype=bool)
    for k in range(size - 1):
        inner &= ids[k : k + n] > 0
    at = np.flatnonzero(inner)
    part = np.zeros(n, dtype=bool)
    part[at] = _known(known, phrase_hash([hashed[ids[at + k]] for k in range(size - 1)]))
    starts = np.flatnonzero(part[:-1] & part[1:])
    if not len(starts):
        return none
    columns = [ids[starts + k] for k in range(size)]
    used = np.unique(np.concatenate(columns))
    order = sorted(range(len(used)), key=lambda k: labels[used[k] - 1])
    rank = np.zeros(len(hashed), dtype=np.int64)
    rank[used[order]] = np.arange(len(used))
    names = [labels[used[k] - 1] for k in order]
    code = rank[columns[0]]
    for column in columns[1:-1]:
        code = np.unique(code * len(used) + rank[column], return_inverse=True)[1]
    _, first, counts = np.unique(code * len(used) + rank[columns[-1]], return_index=True, return_counts=True)
    langs = sorted(by_lang)
    of = np.array([langs.index(lang) for lang, _ in names], dtype=np.int64)
    picked = [rank[c[first]] for c in columns]
    words = [w for _, w in names]
    return Phrases([of[picked[0]], *picked], [langs, *[words] * size], counts)


def prefix_cuts(words: DataFrame, total: int, parts: int) -> list[tuple]:
    """Ascending prefixes (lang, word) or (lang, word, word) that cut all phrases into ranges.

    Words drawn by a hash stand for the rest; a word with more than a range's share of all
    is cut by its second word. What is collected is bounded by the number of ranges, and
    decides which task counts a phrase, not the count.
    """
    drawn = words.orderBy(F.xxhash64("lang", "phrase"), "lang", "phrase").limit(32 * parts).collect()
    share = max(1, total // parts)
    heavy = words.filter(F.col("f") > share).collect()  # fewer than `parts` rows
    light = sorted((r["lang"], r["phrase"].encode(), r["f"]) for r in drawn if r["f"] <= share)
    mass = np.cumsum([f for *_, f in light])
    cuts = {light[int(np.searchsorted(mass, mass[-1] * k / parts))][:2] for k in range(1, parts) if light}
    for r in heavy:
        lang, word = r["lang"], r["phrase"].encode()
        # its followers are about as frequent as words are elsewhere
        second = sorted((q["phrase"].encode(), min(q["f"], share)) for q in drawn if q["lang"] == lang)
        pieces, weight = -(-r["f"] // share), np.cumsum([f for _, f in second])
        cuts |= {(lang, word), (lang, word + b"\0")}
        if second:
            at = np.searchsorted(weight, weight[-1] * np.arange(1, pieces) / pieces)
            cuts |= {(lang, word, second[k][0]) for k in at.tolist()}
    return sorted(cuts)


def count_phrases(rows: DataFrame, size: int, known, cuts: list[tuple], least: int) -> DataFrame:
    """Rows (part, states): for each prefix range the automaton of phrases with `least` or more occurrences.

    Every shard of rows (lang, text) gives an automaton of its sorted phrases for each
    range; a range's automata meet in one task, which sums them up.
    """

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size_held = [], 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                held.append((lang, text))
                size_held += len(text) // 6 + 1  # about a token for six characters
                if size_held >= TOKENS:
                    yield from cut(held)
                    held, size_held = [], 0
        if held:
            yield from cut(held)

    def cut(held: list[tuple[str, str]]) -> Iterator[pd.DataFrame]:
        phrases = shard_phrases(held, size, known.value)
        edges = [0, *[bisect.bisect_left(phrases, c) for c in cuts], len(phrases)]
        for part, (a, b) in enumerate(zip(edges, edges[1:])):
            if b > a:
                yield pd.DataFrame({"part": [part], "states": [_pack(phrases.states(a, b))]})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, total = None, {}
        for batch in batches:
            for number, raw in zip(batch["part"], batch["states"]):
                if number != part:
                    if total:
                        yield summed(part, total)
                    part, total = number, {}
                states = _unpack(raw)
                absorb(total, states, states[-1], size + 1)
        if total:
            yield summed(part, total)

    def summed(part: int, total: dict) -> pd.DataFrame:
        return pd.DataFrame({"part": [part], "states": [_pack(automaton(survivors(total, least, size + 1)))]})

    found = rows.mapInPandas(shards, "part int, states binary")
    dealt = found.repartition(len(cuts) + 1, "part").sortWithinPartitions("part")
    return settle(dealt.mapInPandas(meet, "part int, states binary"))


def phrase_rows(counts: DataFrame) -> DataFrame:
    """Rows (lang, phrase, f) of the automata in rows (part, states)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for raw in batch["states"]:
                found = list(paths(_unpack(raw)))
                yield pd.DataFrame(
                    {
                        "lang": [p[0] for p, _ in found],
                        "phrase": [b" ".join(p[1:]).decode() for p, _ in found],
                        "f": [w for _, w in found],
                    },
                    dtype=object,
                )

    return counts.mapInPandas(rows, "lang string, phrase string, f long")


def part_counts(asked: DataFrame, levels: list[DataFrame], words: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Rows (lang, phrase, f) for rows (lang, phrase): the counts of phrases, looked up by composition.

    In every prefix range the automata of all sizes and the frequent words are united into
    one transducer from phrases to counts, the phrases asked for form an automaton of their
    own, and the two are composed.
    """

    def keyed(phrases: DataFrame) -> DataFrame:
        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keys = [(g, *p.encode().split(b" ")) for g, p in zip(batch["lang"], batch["phrase"])]
                yield batch.astype(object).assign(part=[bisect.bisect_right(cuts, k) for k in keys])

        schema = ", ".join(f"{n} {t}" for n, t in phrases.dtypes)
        return phrases.mapInPandas(place, f"{schema}, part int")

    def look(questions: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        singles = answers[answers["states"].isna()]
        own = sorted(((g, p.encode()), int(f)) for g, p, f in zip(singles["lang"], singles["phrase"], singles["f"]))
        counts = union([automaton(own), *[_unpack(raw) for raw in answers["states"].dropna()]])
        wanted = sorted({(g, *p.encode().split(b" ")) for g, p in zip(questions["lang"], questions["phrase"])})
        found = list(compose(automaton((w, 1) for w in wanted), counts))
        return pd.DataFrame(
            {
                "lang": [p[0] for p, _ in found],
                "phrase": [b" ".join(p[1:]).decode() for p, _ in found],
                "f": [w for _, w in found],
            },
            dtype=object,
        )

    answers = keyed(words.select("lang", "phrase", "f")).withColumn("states", F.lit(None).cast("binary"))
    for level in levels:
        answers = answers.unionByName(level, allowMissingColumns=True)
    questions = keyed(asked.select("lang", "phrase"))
    return questions.groupBy("part").cogroup(answers.groupBy("part")).applyInPandas(look, "lang string, phrase string, f long")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    inside: int = INSIDE,
    top: int | None = TOP,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """The first `top` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z and cut into pieces at `.,;:!?` and line ends, pieces into
    words at spaces and tabs. a, l and r count all contiguous occurrences of a phrase of 2
    to `longest` words, and of the parts before and behind a cut, inside pieces; n counts
    all words of the language. Phrases with a >= least are candidates; the score is that of
    the cut with the lowest floor(2000000 * a / (l + r)), the first of these. Candidates go
    that lie inside a longer candidate with 100 * f >= inside * a. Order is by score and a,
    falling, then by the phrase's bytes; no `top` gives all.

    Counting goes size by size. No frequent phrase has an infrequent part, so a task leaves
    out what a filter of fixed size does not know from the size before; the filter errs only
    towards counting more. Shards build automata from their sorted phrases, and ranges of
    prefixes sum them up; counts of parts come from composing with these.

    A null text is empty; a null language is `und`, together with rows that say so; repeated
    rows all count; ids and other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), whole_text(text_col).alias("text")
    )
    counted = settle(count_words(rows))
    sums = counted.groupBy("lang").agg(F.sum("f").cast("long").alias("n"))
    words = settle(counted.filter(F.col("f") >= least))
    total = words.agg(F.sum("f")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // RANGE_WORDS)
    cuts = prefix_cuts(words, total, parts)
    levels, frequent, before = [], [], words
    for size in range(2, longest + 1):
        known = spark.sparkContext.broadcast(bit_filter(before, bits))
        levels.append(count_phrases(rows, size, known, cuts, least))
        before = settle(phrase_rows(levels[-1]))
        frequent.append(before.withColumn("words", F.split("phrase", " ")))
    candidates = frequent[0]
    for more in frequent[1:]:
        candidates = candidates.unionByName(more)

    def part(first, size):
        return F.array_join(F.slice("words", first, size), " ")

    size = F.size("words")
    cut = candidates.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cut = settle(
        cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, size).alias("right"))
    )
    asked = cut.select("lang", F.col("left").alias("phrase")).unionByName(cut.select("lang", F.col("right").alias("phrase")))
    counts = settle(part_counts(asked.distinct(), levels, words, cuts))
    scored = cut.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    scored = scored.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr("(CAST(a AS DECIMAL(19, 0)) * 2000000BD) div (CAST(l AS DECIMAL(19, 0)) + r)").alias("score")
    lowest = scored.select("lang", "phrase", "a", "k", "l", "r", score).groupBy("lang", "phrase", "a")
    lowest = lowest.agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "phrase", "a", "m.score", "m.l", "m.r")

    spans = candidates.filter(size > 2).select(
        "lang",
        F.col("f").alias("longer"),
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size(words) - 1), s -> transform(sequence(1, size(words) - s + 1), "
                "i -> array_join(slice(words, i, s), ' '))))"
            )
        ).alias("phrase"),
    )
    around = spans.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.expr(f"CAST(longer AS DECIMAL(19, 0)) * 100 >= CAST(a AS DECIMAL(19, 0)) * {int(inside)}")
    left = lowest.join(around, ["lang", "phrase"], "left").filter(F.coalesce(~covered, F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = {
    "op12_collocations": r"""
        WITH t AS (
            SELECT coalesce(lang, 'und') AS lang,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s
            FROM documents),
        p AS (SELECT lang, unnest(string_split_regex(s, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
        w AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM p),
        n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
        g AS (
            SELECT lang, k, unnest([ws[i : i + k - 1] FOR i IN range(1, len(ws) - k + 2)]) AS ph
            FROM w, (VALUES (1), (2), (3), (4)) AS v(k) WHERE len(ws) >= k),
        f AS (SELECT lang, k, ph, count(*) AS c FROM g GROUP BY ALL HAVING count(*) >= 30),
        c AS (SELECT lang, k, ph, c AS a FROM f WHERE k > 1),
        cut AS (SELECT lang, k, ph, a, unnest(range(1, k)) AS j FROM c),
        scored AS (
            SELECT x.lang, x.ph, x.a, x.j, l.c AS l, r.c AS r, ((2000000::HUGEINT * x.a) // (l.c + r.c))::BIGINT AS score
            FROM cut x
            JOIN f l ON l.lang = x.lang AND l.ph = x.ph[1 : x.j]
            JOIN f r ON r.lang = x.lang AND r.ph = x.ph[x.j + 1 : x.k]),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, j) = 1),
        spans AS (
            SELECT lang, k, a, ph, unnest(flatten([[ph[i : i + s - 1] FOR i IN range(1, k - s + 2)] FOR s IN range(2, k)])) AS sub
            FROM c WHERE k > 2),
        around AS (SELECT lang, sub, max(a) AS longer FROM spans GROUP BY lang, sub),
        kept AS (
            SELECT y.lang, array_to_string(y.ph, ' ') AS phrase, y.a, y.l, y.r, y.score
            FROM lowest y LEFT JOIN around z ON z.lang = y.lang AND z.sub = y.ph
            WHERE z.longer IS NULL OR 100::HUGEINT * z.longer < 80::HUGEINT * y.a),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
        SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
    """
}
QUERIES = {"op12_collocations": op12_collocations}
