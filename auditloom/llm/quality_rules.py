r"""Line-first cleaning with document rules.

Each line is judged by itself: by its punctuation (no sentence end, shouting,
symbols hung on words), as navigation (cells between bars, a few loose words)
and as boilerplate (licence, rights and cookie phrases). Lines that fail are
removed; a document is rejected when the removed lines hold more than
`MOST_LOST` of its characters, or when a base rule fails: fewer
than 50 words, or more than half of its words in repeated three-word windows.

All is done within a row by built-in functions. Three-word windows are found
again by sorting packed (hash, position) numbers and comparing neighbours, word
by word where hashes agree, so a row costs n log n and no shuffle. Texts beyond
2^20 words take the same path on unpacked pairs.

Defined cases: a null text has no words and fails; the cleaned text of a null
text is null. Repeated rows are judged one by one.
"""

from pyspark.sql import functions as F

from auditloom.llm.common import computed, let, query, table

SPACES = " \t\n\u000b\u000c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Base rules.
LEAST_WORDS, MOST_REPEATED = 50, 0.5
#: Largest share of a document's word characters in removed lines.
MOST_LOST = 0.4
#: Line rules: symbols a word, share of shouted words, loose words of a navigation line.
SYMBOLS_A_WORD, SHOUTED, LOOSE_WORDS = 0.3, 0.5, 3

#: Lower-case phrases of boilerplate lines.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "under the terms of",
    "public license",
    "accept cookies",
    "accept all cookies",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "subscribe to our newsletter",
    "click here",
    "sign in to",
    "log in to",
)
#: Sentence end before closing quotes or brackets, looked for in a line's last characters.
_ENDS = r"""[.!?…:;。！？]["'»”’)\]]*$"""
_LAST = 4


def without(text, chars):
    """`text` without any of `chars`."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def words(text):
    """The words of a text without nulls."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def window_hash(window):
    """A hash of a window's words, given as columns."""
    return F.xxhash64(*window)


def repeated_words(words_, window=3):
    """Words in windows that are found twice or more in an array of words.

    Places are sorted by the hash of their window, in one number each where hash
    and place fit into it, and neighbours are compared word by word. Where
    different windows of a text turn out to share a hash, its places are sorted
    by the words themselves, so that the count is exact.
    """
    size = F.size(words_)
    last = size - window
    places_ = F.sequence(F.lit(0), last)
    shown = lambda i: [F.get(words_, (i + k).cast("int")) for k in range(window)]

    def packed(bits):
        return F.transform(places_, lambda i: F.shiftleft(window_hash(shown(i)), bits).bitwiseOR(i.cast("long")))

    def plain():
        return F.transform(places_, lambda i: F.struct(window_hash(shown(i)).alias("h"), i.cast("long").alias("p")))

    def spelled():
        return F.transform(
            places_,
            lambda i: F.struct(*[w.alias(f"w{k}") for k, w in enumerate(shown(i))], i.cast("long").alias("p")),
        )

    def met_again(sorted_, same, place_of):
        again = F.filter(sorted_, lambda x, i: same(x, F.get(sorted_, i - 1)) | same(x, F.get(sorted_, i + 1)))
        return F.sort_array(F.transform(again, place_of))

    def exactly():
        def same(a, b):
            equal = F.lit(True)
            for k in range(window):
                equal = equal & (a[f"w{k}"] == b[f"w{k}"])
            return F.coalesce(equal, F.lit(False))

        return let(F.sort_array(spelled()), lambda s: met_again(s, same, lambda x: x["p"]))

    def found(sorted_, hash_of, place_of):
        def equal(a, b):
            words_equal = F.lit(True)
            for mine, other in zip(shown(place_of(a)), shown(place_of(b))):
                words_equal = words_equal & (mine == other)
            return words_equal

        def same(a, b):
            return F.coalesce((hash_of(a) == hash_of(b)) & equal(a, b), F.lit(False))

        def clash(a, b):
            return F.coalesce((hash_of(a) == hash_of(b)) & ~equal(a, b), F.lit(False))

        clashes = F.filter(sorted_, lambda x, i: clash(x, F.get(sorted_, i + 1)))
        return F.when(F.size(clashes) > 0, exactly()).otherwise(met_again(sorted_, same, place_of))

    def covered(places):
        zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            places,
            zero,
            lambda a, p: F.struct(
                (p + window).alias("end"), (a["n"] + window - F.greatest(a["end"] - p, F.lit(0))).alias("n")
            ),
            lambda a: a["n"],
        )

    bits = 20
    short = let(
        F.sort_array(packed(bits)),
        lambda s: found(s, lambda x: F.shiftright(x, bits), lambda x: x.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))),
    )
    long = let(F.sort_array(plain()), lambda s: found(s, lambda x: x["h"], lambda x: x["p"]))
    places = F.when(size < window, F.array().cast("array<bigint>")).when(size <= 1 << bits, short).otherwise(long)
    return covered(places)


def line_verdict(line):
    """Why a line fails, or null. Lines without a word never fail.

    A line's words are counted by its single spaces.
    """

    def judged(trimmed):
        size = F.char_length(trimmed) - F.char_length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1
        symbols = F.char_length(trimmed) - F.char_length(without(trimmed, SYMBOLS))
        twice = F.char_length(trimmed) - F.char_length(F.replace(trimmed, F.lit("!!"), F.lit("")))
        bars = F.char_length(trimmed) - F.char_length(F.replace(trimmed, F.lit("|"), F.lit("")))
        boilerplate = let(F.lower(trimmed), lambda low: _any_in(low, BOILERPLATE))
        return (
            F.when(trimmed == "", None)
            .when(boilerplate, "boilerplate")
            .when((bars >= 2) & (bars * 4 >= size), "navigation")
            .when((size <= LOOSE_WORDS) & ~F.right(trimmed, F.lit(_LAST)).rlike(_ENDS), "navigation")
            .when(symbols >= size * SYMBOLS_A_WORD, "punctuation")
            .when(twice >= size * 2 * SHOUTED, "punctuation")
        )

    return let(F.btrim(line, F.lit(SPACES)), judged)


def _any_in(text, phrases):
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(text, F.lit(phrase))
    return found


def clean(df, text_col="text"):
    """`df` with the base columns, `lost_chars`, `cleaned` and `kept`.

    Input columns of the same names are replaced. `lost_chars` counts the
    characters of removed lines.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    made = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed lost_chars cleaned kept"
    facts = computed(
        df.drop(*made.split()).withColumns(
            {
                "_lines": F.transform(
                    F.split(text, "\n"), lambda x: F.struct(x.alias("line"), line_verdict(x).alias("why"))
                ),
                "_words": let(
                    words(text),
                    lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("again")),
                ),
            }
        ),
        "_lines",
        "_words",
    )
    held = F.filter(F.col("_lines.line"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    failing = F.filter("_lines", lambda x: x["why"].isNotNull())
    n_words, again = F.col("_words.n"), F.col("_words.again")
    failed = (n_words < LEAST_WORDS) | (again > MOST_REPEATED * n_words)
    lost = F.aggregate(failing, F.lit(0).cast("long"), lambda n, x: n + F.char_length(x["line"]).cast("long"))
    passing = F.filter("_lines", lambda x: x["why"].isNull())
    facts = computed(
        facts.withColumns(
            {
                "n_dup_lines": let(held, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")),
                "lost_chars": lost,
            }
        ),
        "n_dup_lines",
        "lost_chars",
    )
    return facts.withColumns(
        {
            "n_words": n_words,
            "word_chars": F.char_length(without(text, SPACES)).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(without(text, SYMBOLS))).cast("long"),
            "n_repeat_words": again,
            "base_failed": failed,
            "cleaned": F.when(
                F.col(text_col).isNotNull(), F.array_join(F.transform(passing, lambda x: x["line"]), "\n")
            ),
            "kept": ~failed & (F.col("lost_chars") <= MOST_LOST * F.char_length(text)),
        }
    ).drop("_lines", "_words")


ORACLE = r"""
    with d as (select doc_id, coalesce(text, '') as text,
        row_number() over () as r from documents),
    b as (select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
        list_filter(string_split(text, chr(10)), lambda x: length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g')) > 0) as lines
      from d),
    g as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as t
      from (select r, w, unnest(range(1, len(w) - 1)) as i from b)),
    again as (select r, i from (select r, i, count(*) over (partition by r, t) as n from g) where n > 1),
    covered as (select r, count(distinct i + k) as n from again, (select unnest([0, 1, 2]) as k) group by r),
    t as (select r, x, trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as y from (select r, unnest(lines) as x from b)),
    v as (select r, length(x) as chars, length(y) - length(replace(y, ' ', '')) + 1 as size,
        length(y) - length(regexp_replace(y, '[#*$%&|<>]', '', 'g')) as symbols,
        length(y) - length(replace(y, '!!', '')) as twice, length(y) - length(replace(y, '|', '')) as bars,
        regexp_matches(y, '[.!?…:;。！？]["''»”’)\]]*$') as ended,
        regexp_matches(lower(y), 'all rights reserved|licensed under|released under the|under the terms of|public license|accept cookies|accept all cookies|cookie policy|privacy policy|terms of use|terms of service|subscribe to our newsletter|click here|sign in to|log in to') as boiler
      from t),
    lost as (select r, sum(chars) as n from v
      where boiler or (bars >= 2 and bars * 4 >= size) or (not ended and size <= 3)
        or symbols >= size * 0.3 or twice >= size group by r),
    f as (select b.doc_id, len(w)::bigint as n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(covered.n, 0)::bigint as n_repeat_words, coalesce(lost.n, 0) as lost, length(text) as chars
      from b left join covered using (r) left join lost using (r))
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
      not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and lost <= 0.4 * chars as kept
    from f"""


@query("op7_quality_rules", ORACLE)
def op7_quality_rules(spark, sf_dir):
    """Base counts of all documents and whether they are kept."""
    return clean(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
