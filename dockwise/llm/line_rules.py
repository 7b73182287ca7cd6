"""Quality rules: lines are judged first, documents by what is left of them; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwise.llm.common import WHITE, free_name, table, whole_text

#: Words that a document needs, and hundredths of its words that may lie in repeated windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Words of a repeated window.
WINDOW = 3
#: Hundredths of its characters that a document may lose with the lines that fail.
MOST_LOST = 40
#: A line with fewer words than this has to end like a sentence.
SHORT_LINE = 10
#: A line of this many words is prose, whatever notice it speaks of.
LONG_LINE = 40
#: A line may have one stray mark for this many words, and one separator for this many.
WORDS_PER_MARK, WORDS_PER_SEPARATOR = 5, 4

# Patterns that Java and RE2 read alike.
SYMBOLS = r"[#*$%&|<>]"
#: Symbols of markup and code, and repeated marks of exclamation or question.
MARKS = r"[#*$%&<>{}\\^~]|[!?][!?]+"
#: What parts the entries of menus, paths of pages and lists of links.
SEPARATORS = r"[|\x{00BB}\x{203A}\x{2022}\x{00B7}\x{2192}]"
#: Sentence ends of several scripts, behind which quotes and brackets may close.
ENDS = r"[.!?:;\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{061F}\x{0964}][\"'\x{201D}\x{2019}\x{00BB})\]]*[\x20\x09-\x0D]*$"
#: Lines that are nothing but an entry of a menu.
MENU = (
    r"(?i)^[\x20\x09-\x0D]*(home|menu|search|login|log in|log out|sign in|sign up|register|next|previous|back|back to top|"
    r"skip to content|skip to main content|contact|contact us|about|about us|help|faq|sitemap|site map|share|print|"
    r"more|read more|see also|related|comments|reply|subscribe|follow us|startseite|suche|anmelden|kontakt|impressum|"
    r"accueil|recherche|connexion|inicio|buscar|contacto)[\x20\x09-\x0D.:!]*$"
)
#: Phrases of notices that sites put on every page.
NOTICES = (
    r"(?i)(all rights reserved|licensed under|released under|this work is licensed|terms of (use|service)|privacy policy|"
    r"cookie (policy|settings|consent)|uses? cookies|accept (all )?cookies|enable javascript|javascript is (disabled|required)|"
    r"lorem ipsum|click here|subscribe to our|sign up for our|powered by|copyright \(c\)|copyright [12][0-9]{3}|"
    r"\x{00A9} ?[12][0-9]{3}|alle rechte vorbehalten|tous droits r.serv.s|todos los derechos reservados)"
)
RULES = ["boilerplate", "navigation", "punctuation"]


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE + "+"), "")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, WHITE + "+", ""))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """How many words lie in windows of `width` words that the array holds more than once.

    Windows without an equal hash have no equal; hashes are sorted with their places, so that
    equal ones lie side by side, and the windows of those are sorted and compared
    themselves. The places that are left are sorted, and each adds the words up to the next,
    a window at most.
    """

    def hashed(words: Column, starts: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))

    def twins(ranked: Column) -> Column:
        def twin(x: Column, j: Column) -> Column:
            # beyond either end there is null, which equals nothing
            before, after = F.get(ranked, j - 1)["w"], F.get(ranked, j + 1)["w"]
            return F.coalesce(before == x["w"], F.lit(False)) | F.coalesce(after == x["w"], F.lit(False))

        return F.transform(F.filter(ranked, twin), lambda x: x["at"])

    def spread(at: Column) -> Column:
        gaps = F.transform(at, lambda x, j: F.least(F.coalesce(F.get(at, j + 1) - x, F.lit(width)), F.lit(width)))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def exact(words: Column, at: Column) -> Column:
        def window(i: Column) -> Column:
            return F.struct(F.concat_ws(" ", *[F.get(words, i + k) for k in range(width)]).alias("w"), i.alias("at"))

        found = F.sort_array(F.transform(at, window))
        return _bound(found, lambda r: _bound(F.sort_array(twins(r)), spread))

    def compared(words: Column, hashes: Column, starts: Column) -> Column:
        ranked = F.sort_array(F.arrays_zip(hashes.alias("w"), starts.alias("at")))
        found = _bound(ranked, lambda r: _bound(twins(r), lambda at: exact(words, at)))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(found)

    def of(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - width)
        return _bound(starts, lambda s: _bound(hashed(words, s), lambda h: compared(words, h, s)))

    return _bound(words, lambda w: F.when(F.size(w) > width, of(w)).otherwise(F.lit(0)))


def failed_rule(line: Column) -> Column:
    """The first rule that a line fails; null for a good line and for one without words."""

    def judged(n_words: Column) -> Column:
        notice = (n_words < LONG_LINE) & line.rlike(NOTICES)
        separators = F.regexp_count(line, F.lit(SEPARATORS))
        crowded = _bound(separators, lambda n: (n >= 2) & (n * WORDS_PER_SEPARATOR >= n_words))
        marked = F.regexp_count(line, F.lit(MARKS)) * WORDS_PER_MARK > n_words
        unended = (n_words < SHORT_LINE) & ~line.rlike(ENDS)
        return (
            F.when(n_words == 0, F.lit(None).cast("string"))
            .when(notice, "boilerplate")
            .when((n_words < SHORT_LINE) & line.rlike(MENU) | crowded, "navigation")
            .when(marked | unended, "punctuation")
        )

    return _bound(F.size(words_of(line)), judged)


def _by(rule: str) -> Callable[[Column], Column]:
    return lambda x: x["rule"] == rule


def clean_lines(docs: DataFrame, text_col: str = "text", most_lost: int = MOST_LOST) -> DataFrame:
    """The rows and columns of docs and a struct `rules` with what the rules say of each text.

    A text is split at line feeds. A line goes that is a notice of fewer than 40 words (boilerplate), a menu entry or
    crowded with separators (navigation), or full of stray marks or too short for a line
    without an end (punctuation); lines without words stay. The struct holds

    * clean_text, the lines that stay, and failed, how many went by each rule (a map);
    * n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word
      that equal an earlier one), n_repeat_words (words in three-word windows that occur
      twice or more);
    * lost_chars (code points in the words of the lines that went);
    * base_failed: fewer than 50 words, or more than half of them in repeated windows;
    * kept: not base_failed, and not more than `most_lost` hundredths of word_chars lost.

    A null text is empty: no words, so it fails. Repeated rows and null ids are judged like
    any; an empty table stays empty; a column named `rules` of docs is replaced, all others stay.
    Everything happens inside a row, in expressions of the engine: nothing is shuffled, and a
    very long text takes time in proportion to its length (a sort of its windows apart).
    """
    text, words, lines, whole = (free_name(docs.columns, n) for n in ("text_", "words_", "lines_", "word_chars_"))
    rows = docs.withColumn(text, whole_text(text_col))
    split = F.split(F.col(text), "\n", -1)
    rows = rows.withColumns(
        {
            words: words_of(F.col(text)),
            whole: word_chars(F.col(text)),
            lines: F.transform(split, lambda x: F.struct(x.alias("line"), failed_rule(x).alias("rule"))),
        }
    )
    good = F.transform(F.filter(lines, lambda x: x["rule"].isNull()), lambda x: x["line"])
    bad = F.filter(lines, lambda x: x["rule"].isNotNull())
    lost = F.aggregate(bad, F.lit(0), lambda total, x: total + word_chars(x["line"]))
    wordy = F.transform(F.filter(lines, lambda x: x["line"].rlike(r"[^\x20\x09-\x0D]")), lambda x: x["line"])
    failed = F.map_from_arrays(
        F.array(*[F.lit(r) for r in RULES]),
        F.array(*[F.size(F.filter(bad, _by(r))).cast("long") for r in RULES]),
    )
    measured = F.struct(
        F.array_join(good, "\n").alias("clean_text"),
        failed.alias("failed"),
        F.size(words).cast("long").alias("n_words"),
        F.col(whole).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _bound(wordy, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col(words)).cast("long").alias("n_repeat_words"),
        lost.cast("long").alias("lost_chars"),
    )
    out = free_name(docs.columns, "rules_")
    m = F.col(out)
    base = (m["n_words"] < LEAST_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MOST_REPEATED)
    kept = ~base & (m["lost_chars"] * 100 <= m["word_chars"] * most_lost)
    judged = rows.withColumn(out, measured).withColumn("rules", m.withField("base_failed", base).withField("kept", kept))
    return judged.select(*[c for c in docs.columns if c.lower() != "rules"], "rules")


def keep_clean(docs: DataFrame, text_col: str = "text", most_lost: int = MOST_LOST) -> DataFrame:
    """The rows of docs that `clean_lines` keeps, with the lines that fail taken out of their texts.

    Columns stay as they are; n_chars, where docs has it, is set to the length of a changed text.
    """
    rows = clean_lines(docs, text_col, most_lost).filter("rules.kept")
    clean = F.col("rules.clean_text")
    changed = {text_col: clean}
    if "n_chars" in docs.columns:
        size = F.length(clean).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(clean == F.col(text_col), F.col("n_chars")).otherwise(size)
    return rows.withColumns(changed).select([c for c in docs.columns if c.lower() != "rules"])


def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *[F.col(f"rules.{n}").alias(n) for n in names])


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


SQL = {
    "op13_rules": rf"""
        WITH t AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS s FROM documents),
        w AS (
            SELECT *, [x FOR x IN string_split_regex(s, '[\x20\x09-\x0D]+') IF x <> ''] AS ws, string_split(s, chr(10)) AS ls
            FROM t),
        v AS (SELECT row, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) > 2),
        twin AS (
            SELECT row, i, count(*) OVER (PARTITION BY row, ws[i], ws[i + 1], ws[i + 2]) AS n FROM v),
        covered AS (
            SELECT row, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT row, unnest([i, i + 1, i + 2]) AS p FROM twin WHERE n > 1) GROUP BY row),
        l AS (SELECT row, unnest(ls) AS line FROM w),
        m AS (
            SELECT row, line,
                   len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
                   length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
                   len(regexp_extract_all(line, {_quoted(SEPARATORS)})) AS seps,
                   len(regexp_extract_all(line, {_quoted(MARKS)})) AS marks,
                   n < {LONG_LINE} AND regexp_matches(line, {_quoted(NOTICES)}) AS notice,
                   regexp_matches(line, {_quoted(MENU)}) AS menu,
                   regexp_matches(line, {_quoted(ENDS)}) AS ended
            FROM l),
        d AS (
            SELECT row, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
                   coalesce(sum(chars) FILTER (n > 0 AND (notice OR menu
                       OR (seps >= 2 AND seps * {WORDS_PER_SEPARATOR} >= n)
                       OR marks * {WORDS_PER_MARK} > n OR (n < {SHORT_LINE} AND NOT ended))), 0) AS lost
            FROM m GROUP BY row),
        f AS (
            SELECT doc_id, len(ws)::BIGINT AS n_words,
                   length(regexp_replace(s, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
                   len(regexp_extract_all(s, {_quoted(SYMBOLS)}))::BIGINT AS n_symbols,
                   n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, lost
            FROM w JOIN d USING (row) LEFT JOIN covered USING (row))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost * 100 <= word_chars * {MOST_LOST} AS kept
        FROM f
    """
}
QUERIES = {"op13_rules": op13_rules}
