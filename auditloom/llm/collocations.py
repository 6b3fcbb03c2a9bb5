"""Phrase collocations by double-array tries over words.

Texts are kept as 64-bit hashes of their words, a zero standing before each
piece. Phrases that can be frequent are found level by level: a phrase is a
candidate only if it is a frequent phrase, one word shorter, followed often
enough by a word with which its own tail is a frequent phrase too. The candidates of a level go
into double-array tries of bounded size, each broadcast in turn. A task walks
all positions of its texts at once: each step moves every state that is left by
one word, and the accepting states are binned and counted. The same pass sums the
words that follow, of which the next level is made. The sums over all tasks decide
which candidates are frequent.

A word's hash stands for it only while no other word of the language shares it;
otherwise all words are hashed anew with the next seed.
"""

from collections import Counter, defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.common import query, table
from auditloom.llm.components import stored

#: Most phrases of a trie, as dealt by hash, which bounds each broadcast.
TRIE_PHRASES = 500_000
#: Bits of the place of a phrase in the filter of possible tails, whose size is fixed by it.
FILTER_BITS = 22
#: Positions that are walked at a time, and rows of new phrases that a task holds before it hands them on.
POSITIONS = 2_000_000
HELD = 500_000
#: Words that a task holds before it hands them on, and hashes that it remembers.
HELD_WORDS, KNOWN_WORDS = 100_000, 300_000
#: Stands before each piece, so that no phrase reaches across.
BREAK = 0
_FREE, _ROOT = -1, -2


class DoubleArray:
    """A trie of phrases of one length: state `s` moves by code `c` to `t = base[s] + c` if `check[t] == s`.

    `langs` and the rows of `hashes` are the phrases; each language has a root.
    """

    def __init__(self, langs, hashes, numbers):
        self.alphabet = np.unique(hashes)
        self.roots = {lang: slot for slot, lang in enumerate(sorted(set(langs)))}
        self.length = hashes.shape[1]
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, _FREE, np.int64)
        self._room(len(self.roots))
        self.check[: len(self.roots)] = _ROOT
        codes = np.searchsorted(self.alphabet, hashes)
        states = np.array([self.roots[lang] for lang in langs], np.int64)
        for level in range(self.length):
            edges, of = np.unique(states * len(self.alphabet) + codes[:, level], return_inverse=True)
            states = self._place(*np.divmod(edges, max(1, len(self.alphabet))))[of]
        # So that no move leaves the arrays.
        last = np.nonzero(self.check != _FREE)[0].max(initial=0) + 1
        self._room(last + len(self.alphabet) + 1)
        self.numbers = np.asarray(numbers)
        self.bin = np.full(len(self.check), -1, np.int64)
        self.bin[states] = np.arange(len(states))

    def _room(self, size):
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, _FREE, np.int64)])

    def _place(self, parents, codes):
        """Slots of the edges (parent, code), given in order; sets their parents' bases."""
        starts = np.nonzero(np.diff(parents, prepend=-1))[0]
        sizes = np.diff(np.append(starts, len(parents)))
        slots, low, width = np.empty(len(parents), np.int64), len(self.roots), 256
        # The largest families first; blocks that had no room for one are passed over for good.
        for family in np.argsort(-sizes, kind="stable")[: (sizes > 1).sum()]:
            mine = slice(starts[family], starts[family] + sizes[family])
            children, at = codes[mine], low
            while True:
                self._room(at + width + children[-1] + 1)
                clash = (self.check[np.arange(at, at + width)[:, None] + children] != _FREE).any(axis=1)
                if not clash.all():
                    break
                low = at = at + width
            base = at + int(clash.argmin())
            slots[mine] = base + children
            self.check[base + children] = parents[mine]
            self.base[parents[starts[family]]] = base
        # An only child fits anywhere, also where the families left room.
        single = starts[sizes == 1]
        self._room(len(self.check) + len(single) + len(self.alphabet))
        free = np.nonzero(self.check == _FREE)[0]
        slots[single] = free[free >= len(self.alphabet)][: len(single)]
        self.check[slots[single]] = parents[single]
        self.base[parents[single]] = slots[single] - codes[single]
        return slots

    def walk(self, roots, hashes, start, stop):
        """(position, bin) of each phrase that begins in `start` to `stop`; `roots` are the positions' roots."""
        some = hashes[start : stop + self.length - 1]
        codes = np.searchsorted(self.alphabet, some)
        codes[codes == len(self.alphabet)] = 0
        known = self.alphabet[codes] == some if len(self.alphabet) else np.zeros(len(some), bool)
        place = np.nonzero((roots[start:stop] >= 0) & known[: stop - start])[0]
        state = roots[start:stop][place]
        for level in range(self.length):
            if level:
                inside = place + level < len(some)
                place, state = place[inside], state[inside]
                go_on = known[place + level]
                place, state = place[go_on], state[go_on]
            after = self.base[state] + codes[place + level]
            fits = self.check[after] == state
            place, state = place[fits], after[fits]
        return place + start, self.bin[state]


def _positions(batch, roots):
    """Hashes of all texts of a batch in a row, and the root of each position's language."""
    lists = batch.column(1)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    mine = np.array([roots.get(lang, -1) for lang in batch.column(0).to_pylist()], np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(mine, sizes)


def _slices(size):
    return ((start, min(start + POSITIONS, size)) for start in range(0, size, POSITIONS))


def _filter_places(columns):
    """Place of each phrase, given as columns of hashes, in a filter."""
    mixed = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _matrix(lists, length):
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _tail_filter(frequent, length):
    """Which places the frequent phrases have: a fixed number of bits, whatever their number."""

    def run(batches):
        for batch in batches:
            places = np.unique(_filter_places(_matrix(batch.column(0), length).T))
            yield pa.RecordBatch.from_arrays([pa.array(places)], names=["place"])

    taken = frequent.select("phrase").mapInArrow(run, "place long").distinct().toArrow()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[taken.column(0).to_numpy()] = True
    return np.packbits(bits)


def _tries(phrases, length, most):
    """The broadcast tries of a table of phrases, one after the other."""
    chunks = max(1, -(-phrases.count() // most))
    dealt = phrases.withColumn("chunk", F.pmod(F.xxhash64("number"), F.lit(chunks)))
    for chunk in range(chunks):
        rows = dealt.where(F.col("chunk") == chunk).select("lang", "phrase", "number").toArrow().combine_chunks()
        if rows.num_rows:
            hashes = _matrix(rows.column(1).combine_chunks(), length)
            trie = DoubleArray(rows.column(0).to_pylist(), hashes, rows.column(2).to_numpy())
            yield phrases.sparkSession.sparkContext.broadcast(trie)


def _united(frames):
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def walked(texts, phrases, length, least, most, count, extend):
    """(counts, longer) of one pass over `texts` with the tries of `phrases` (lang, phrase, number) of `length` words.

    `counts` (number, f) holds what is met at least `least` times, in all of `texts`, if `count`. `longer`
    (number, next), if `extend`, holds the words that follow a phrase at least `least` times and whose tail with it
    may be among `phrases`; most are met a few times only and are left out before they fill tries.
    """
    bits = texts.sparkSession.sparkContext.broadcast(_tail_filter(phrases, length)) if extend else None
    made = []
    for trie in _tries(phrases, length, most):

        def run(batches, trie=trie):
            known = trie.value
            tails = np.unpackbits(bits.value).view(bool) if extend else None
            total = np.zeros(len(known.numbers), np.int64)
            held = np.zeros((0, 3), np.int64)

            def out(rows):
                return pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], names=["number", "next", "met"])

            for batch in batches:
                hashes, roots = _positions(batch, known.roots)
                for start, stop in _slices(len(hashes)):
                    place, found = known.walk(roots, hashes, start, stop)
                    if count:
                        total += np.bincount(found, minlength=len(total))
                    if not extend:
                        continue
                    inside = place + length < len(hashes)
                    place, number = place[inside], known.numbers[found[inside]]
                    after = hashes[place + length]
                    tail = [hashes[place + i] for i in range(1, length)] + [after]
                    good = (after != BREAK) & tails[_filter_places(tail)]
                    ones = np.ones(good.sum(), np.int64)
                    held = np.concatenate([held, _summed(np.stack([number[good], after[good], ones], axis=1))])
                    if len(held) > HELD:
                        held = _summed(held)
                        if len(held) > HELD // 2:
                            yield out(held)
                            held = held[:0]
            yield out(_summed(held))
            # No word follows as `BREAK`, which marks the counts.
            met = np.nonzero(total)[0]
            yield out(np.stack([known.numbers[met], np.full(len(met), BREAK, np.int64), total[met]], axis=1))

        sums = texts.mapInArrow(run, "number long, next long, met long").groupBy("number", "next")
        made.append(stored(sums.agg(F.sum("met").alias("met")).where(F.col("met") >= least), "walked"))
        trie.destroy()
    if extend:
        bits.destroy()
    if not made:
        made = [phrases.select("number", F.lit(BREAK).cast("long").alias("next"), F.lit(0).cast("long").alias("met")).limit(0)]
    whole = _united(made)
    counts = whole.where(F.col("next") == BREAK).select("number", F.col("met").alias("f"))
    return counts, whole.where(F.col("next") != BREAK).select("number", "next")


def extended(longer, frequent, length):
    """Candidates of one word more: (lang, phrase) whose first and last words are `frequent` phrases both."""
    whole = longer.join(frequent.select("number", "lang", "phrase"), "number")
    whole = whole.select("lang", F.concat("phrase", F.array("next")).alias("phrase"))
    tail = whole.withColumn("tail", F.slice("phrase", 2, length))
    tails = frequent.select("lang", F.col("phrase").alias("tail"))
    return tail.join(tails, ["lang", "tail"], "left_semi").select("lang", "phrase")


def _summed(rows):
    """The distinct pairs of the first two columns with the sums of the third."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    starts = np.nonzero(new)[0]
    return np.column_stack([rows[starts, :2], np.add.reduceat(rows[:, 2], starts)])


def _numbered(phrases, purpose):
    return stored(phrases.withColumn("number", F.monotonically_increasing_id()), purpose)


# Separators of pieces become a full stop, which no word holds; A-Z become a-z and tabs spaces. All are single
# bytes of UTF-8, so texts are taken as bytes.
_PLAIN = bytes.maketrans(
    b",;:!?\n\x0b\x0c\rABCDEFGHIJKLMNOPQRSTUVWXYZ\t", b"." * 9 + b"abcdefghijklmnopqrstuvwxyz "
)


def _split(text):
    """Words of a text, as bytes, and a full stop before each piece."""
    return [b".", *text.translate(_PLAIN).replace(b".", b" . ").split()] if text else [b"."]


def _texts(batch):
    """The second column of a batch, as bytes."""
    return batch.column(1).cast(pa.binary()).to_pylist()


def _hash(word, seed):
    """A word's hash, as a signed number."""
    value = xxhash.xxh64_intdigest(word, seed)
    return value - (1 << 64) if value >= 1 << 63 else value


class _Known(dict):
    """Hashes of words, made when they are first asked for."""

    def __init__(self, seed):
        super().__init__({b".": BREAK})
        self.seed = seed

    def __missing__(self, word):
        value = self[word] = _hash(word, self.seed)
        return value


def word_counts(texts):
    """(lang, word, f) of all words of `texts` (lang, text)."""

    def run(batches):
        met = defaultdict(Counter)

        def out():
            for lang, words in met.items():
                words.pop(b".", None)
                columns = [pa.array([lang] * len(words), pa.string())]
                columns.append(pa.array(words.keys(), pa.binary()).cast(pa.string()))
                columns.append(pa.array(words.values(), pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "f"])
            met.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), _texts(batch)):
                met[lang].update(_split(text))
            if sum(map(len, met.values())) > HELD_WORDS:
                yield from out()
        yield from out()

    return texts.mapInArrow(run, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def with_hash(words, seed):
    """`words` (lang, word, f) with the hash of each word."""

    def run(batches):
        for batch in batches:
            hashes = pa.array([_hash(word, seed) for word in _texts(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, hashes], names=["lang", "word", "f", "hash"])

    return words.select("lang", "word", "f").mapInArrow(run, "lang string, word string, f long, hash long")


def hashed_texts(texts, seed):
    """`texts` (lang, text) as (lang, hashes), a `BREAK` standing before each piece."""

    def run(batches):
        known = _Known(seed)
        for batch in batches:
            if len(known) > KNOWN_WORDS:
                known = _Known(seed)
            lines = [_split(text) for text in _texts(batch)]
            offsets = np.cumsum([0, *map(len, lines)]).astype(np.int32)
            flat = np.fromiter(map(known.__getitem__, chain.from_iterable(lines)), np.int64, offsets[-1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["lang", "hashes"])

    return texts.mapInArrow(run, "lang string, hashes array<long>")


def frequent_phrases(df, least=100, longest=5, lang_col="lang", text_col="text", most=TRIE_PHRASES):
    """(words, phrases): word counts (lang, word, f, hash) and all phrases of 1 to `longest` words with f >= `least`.

    Phrases are (lang, phrase, f, length), `phrase` being the hashes of the words.
    """
    spark = df.sparkSession
    texts = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    words = stored(word_counts(texts), "words")
    for seed in count():
        hashed = stored(with_hash(words, seed), "hashed-words")
        shared = hashed.groupBy("lang", "hash").agg(F.count("*").alias("words"), F.sum("f").alias("f"))
        # Rare words that share a hash matter only if it then looks frequent.
        if shared.where((F.col("f") >= least) & ((F.col("words") > 1) | (F.col("hash") == BREAK))).isEmpty():
            break
    # As many shards as tasks run at a time: each hands on its sums once.
    texts = stored(hashed_texts(texts, seed), "hashes").coalesce(spark.sparkContext.defaultParallelism)
    found = hashed.where(F.col("f") >= least).select("lang", F.array("hash").alias("phrase"), "f")
    levels = [_numbered(found, "frequent")]
    _, longer = walked(texts, levels[0], 1, least, most, False, longest > 1)
    for length in range(2, longest + 1):
        candidates = _numbered(extended(longer, levels[-1], length - 1), "candidates")
        # Counted and followed in one pass: what follows candidates that are not frequent goes with them.
        counts, longer = walked(texts, candidates, length, least, most, True, length < longest)
        levels.append(stored(candidates.join(counts, "number"), "frequent"))
        if levels[-1].isEmpty():
            break
    whole = _united([level.select("lang", "phrase", "f") for level in levels])
    return hashed, whole.withColumn("length", F.size("phrase"))


def collocations(df, least=100, longest=5, inside=100, first=2000, lang_col="lang", text_col="text", most=TRIE_PHRASES):
    """The `first` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z, cut into pieces at `.,;:!?` and line ends and
    into words at spaces and tabs. A phrase has 2 to `longest` words and occurs
    a >= `least` times in its language, overlaps included. Its score is
    floor(1000 * a * n / (l * r)) of the cut into two parts, occurring l and r
    times, that gives the least one, the earliest of equal cuts; n counts the
    words of the language. A phrase that stands inside a longer one with
    100 * f(longer) >= `inside` * a is left out. Order: score down, a down,
    phrase in byte order.

    A null language is `und`, a null text is empty. Repeated rows count each;
    texts are taken whole. Languages without phrases have no rows. Other columns
    are not looked at.
    """
    # Spark cuts ranked groups down before their shuffle up to this rank.
    limit = "spark.sql.optimizer.windowGroupLimitThreshold"
    df.sparkSession.conf.set(limit, str(max(first, int(df.sparkSession.conf.get(limit)))))
    words, phrases = frequent_phrases(df, least, longest, lang_col, text_col, most)
    phrases = stored(phrases, "phrases")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))

    # A phrase inside one that is longer by more words is inside one of those between, which occurs no less often.
    longer = phrases.where("length > 2")
    shorter = F.array(F.slice("phrase", 1, F.col("length") - 1), F.slice("phrase", 2, F.col("length") - 1))
    around = longer.select("lang", F.explode(shorter).alias("phrase"), "f")
    around = around.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    kept = phrases.where("length > 1").join(around, ["lang", "phrase"], "left")
    kept = kept.where(~F.coalesce(100 * F.col("around") >= inside * F.col("f"), F.lit(False)))

    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "length",
                       F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("cut"))
    cuts = cuts.withColumn("head", F.slice("phrase", F.lit(1), F.col("cut")))
    cuts = cuts.withColumn("tail", F.slice("phrase", F.col("cut") + 1, F.col("length") - F.col("cut")))
    cuts = cuts.join(known.withColumnsRenamed({"part": "head", "part_f": "l"}), ["lang", "head"])
    cuts = cuts.join(known.withColumnsRenamed({"part": "tail", "part_f": "r"}), ["lang", "tail"]).join(totals, "lang")
    wide = {c: f"cast({c} as decimal(19, 0))" for c in "alrn"}
    score = F.expr(f"(1000 * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))

    spelled = best.select("*", F.posexplode("phrase").alias("at", "hash"))
    spelled = spelled.join(words.where(F.col("f") >= least).select("lang", "hash", "word"), ["lang", "hash"])
    # At most `longest` words a phrase.
    spelled = spelled.groupBy("lang", "phrase", "a", "n", "best").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    text = F.array_join(F.col("words.word"), " ")
    rows = spelled.select("lang", text.alias("phrase"), "a", "best.l", "best.r", "n", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
with t as (
  select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
p as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from t),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as words from p),
total as (select lang, sum(len(words))::bigint as n from w group by lang),
g as (
  select lang, k, words[i : i + k - 1] as phrase
  from (select lang, words, k, unnest(range(1, len(words) - k + 2)) as i
        from (select lang, words, unnest(range(1, 6)) as k from w) a) b),
f as (select lang, k, phrase, count(*) as f from g group by lang, k, phrase having count(*) >= 100),
around as (
  select lang, part, max(f) as f
  from (select lang, f, unnest([phrase[1 : k - 1], phrase[2 : k]]) as part from f where k > 2) x group by lang, part),
kept as (
  select f.* from f left join around x on x.lang = f.lang and x.part = f.phrase
  where f.k > 1 and not coalesce(100 * x.f >= 100 * f.f, false)),
cuts as (select *, unnest(range(1, k)) as cut from kept),
scored as (
  select c.lang, c.phrase, c.f as a, h.f as l, r.f as r, t.n, c.cut,
    ((1000::hugeint * c.f * t.n) // (h.f::hugeint * r.f))::bigint as score
  from cuts c join f h on h.lang = c.lang and h.phrase = c.phrase[1 : c.cut]
  join f r on r.lang = c.lang and r.phrase = c.phrase[c.cut + 1 : c.k] join total t on t.lang = c.lang),
best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
spelled as (select lang, array_to_string(phrase, ' ') as phrase, a, l, r, n, score from best),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from spelled)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
"""


@query("op12_collocations", ORACLE)
def op12_collocations(spark, sf_dir):
    """Collocations of all documents, per language."""
    return collocations(table(spark, sf_dir, "documents"))
