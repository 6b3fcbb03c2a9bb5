"""Byte-level byte-pair encoding and decoding by recursive queries.

Each partition opens an in-memory DuckDB. Its merge table has a row for every
way to cut a piece of the vocabulary into two pieces: (left id, right id, id of
the whole, which is its rank). A word that is a piece itself is its token at
once, as in the tiktoken library.

A word no longer than the longest piece is one row: its tokens, one for each
byte at first, and the ranks of their neighbouring pairs. Each step of a
recursive query contracts the leftmost pair of least rank and joins the two
pairs that this makes with the merge table, until no pair of the word is in it.

A longer word starts as one row per byte: (word, position, token). Each step
contracts all pairs that come first within reach, which is the length of the
longest piece before it and twice that behind: only a piece spanning the place
between could let one pair bear on another, so the tokens are the same as by
contracting the first pair of the whole word, in steps that do not grow with
its length.

Decoding joins (position, id) rows with the vocabulary, puts the pieces in the
order of the positions and concatenates those of each text.
"""

import base64
from itertools import chain, islice

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F

from auditloom.llm.common import query, table

#: Words, and tokens of words, that a task remembers at a time.
REMEMBERED = 200_000
REMEMBERED_TOKENS = 4_000_000
#: Bytes of words in one recursive query, and tokens in one decoding query; a longer word has a query of its own.
QUERY_BYTES = 250_000
QUERY_TOKENS = 250_000
#: Rank of a pair that is no piece, above all ranks, and the mark before the first token of a word.
NO_PIECE, MARK = 2**31 - 1, -1

MERGES = """
create table merges as
select l.id::bigint * 4294967296 + r.id as pair, w.id as mid
from (select id, hex, unnest(range(1, length(hex) // 2)) as k from vocab) w
join vocab l on l.hex = substr(w.hex, 1, (2 * k)::int)
join vocab r on r.hex = substr(w.hex, (2 * k + 1)::int)
"""

# One row per byte of each word that is no piece itself.
SYMBOLS = """
  select w.word, w.pos, v.id as tok
  from (select word, hex, unnest(range(0, length(hex) // 2))::int as pos from words
        where hex not in (select hex from vocab)) w
  join vocab v on v.hex = substr(w.hex, 2 * w.pos + 1, 2)
"""

# Words with their tokens, and those that are pieces.
COLLECT = """
select word, list(tok order by pos) as toks
from (select word, pos, tok from cut where {last}
      union all select w.word, 0, v.id from words w join vocab v on v.hex = w.hex)
group by word order by word
"""

# Each step contracts the leftmost pair of least rank of each word. `toks` begins with a mark that is no token;
# `ranks` holds the rank of each token with the next one. Only the pairs with the token before and the one
# behind are new.
ENCODE = f"""
with recursive cut(word, toks, ranks, least) as (
  select word, toks, ranks, list_min(ranks) from words
  union all
  (with found as (
     select word, toks, ranks, least, list_position(ranks, least) as i from cut where least < {NO_PIECE}),
   step as (
     select f.word, f.toks[:i - 1] || [f.least] || f.toks[i + 2:] as toks,
       f.ranks[:i - 2] || [coalesce(b.mid, {NO_PIECE}), coalesce(a.mid, {NO_PIECE})] || f.ranks[i + 2:] as ranks
     from found f
     left join merges b on b.pair = f.toks[i - 1]::bigint * 4294967296 + f.least
     left join merges a on a.pair = f.least::bigint * 4294967296 + f.toks[i + 2])
   select word, toks, ranks, list_min(ranks) from step)
)
select word, toks[2:] as toks from cut where least = {NO_PIECE} order by word
"""

# All steps of words beyond reach: `cut` holds the newest state of each position, and a null token is a
# position merged into the one before.
ENCODE_LONG = f"""
with recursive cut(word, pos, tok) using key (word, pos) as (
  {SYMBOLS}
  union all
  (with pair as (
     select word, pos, tok, lead(tok) over (partition by word order by pos) as after
     from cut where tok is not null),
   ranked as (
     select p.word, p.pos, p.tok, m.mid
     from pair p left join merges m on m.pair = p.tok::bigint * 4294967296 + p.after),
   {{best}},
   marked as (
     select *, lag(chosen, 1, false) over (partition by word order by pos) as gone from best)
   select word, pos, case when gone then null when chosen then mid else tok end from marked)
)
{COLLECT.format(last="tok is not null")}
"""

# All pairs that no other in reach comes before. A pair is calm if contracting it makes no pair of at
# most its rank with what stands beside it. Equal pairs wait for each other only where one of them is not
# calm; of a run of overlapping ones every other is taken from its start.
NEAREST = """
   beside as (
     select *, lag(tok) over line as before, lead(tok, 2) over line as beyond
     from ranked window line as (partition by word order by pos)),
   known as (
     select b.*, coalesce(x.mid > b.mid, true) and coalesce(y.mid > b.mid, true) and coalesce(z.mid > b.mid, true)
       as calm
     from beside b
     left join merges x on x.pair = b.before::bigint * 4294967296 + b.mid
     left join merges y on y.pair = b.mid::bigint * 4294967296 + b.beyond
     left join merges z on z.pair = b.mid::bigint * 4294967296 + b.mid),
   near as (
     select *, min(mid) over (partition by word) is null as ended, mid = min(mid) over reach as least,
       coalesce(bool_and(calm) over left_equals, true) and (calm or count(*) over left_equals = 0) as free,
       row_number() over (partition by word order by pos)
         - row_number() over (partition by word, mid order by pos) as run
     from known
     window reach as (partition by word order by pos range between {back} preceding and {ahead} following),
       left_equals as (partition by word, mid order by pos range between {back} preceding and 1 preceding)),
   best as (
     select word, pos, tok, mid, coalesce(
       least and free and (not calm or bool_and(least and free) over begun and row_number() over begun % 2 = 1),
       false) as chosen
     from near where not ended window begun as (partition by word, mid, run order by pos))
"""

DECODE = """
select v.piece from tokens t left join vocab v on v.id = t.id order by t.pos
"""


def read_ranks(data):
    """Piece bytes to rank, of the bytes of a rank file (base64 piece, space, rank)."""
    return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, data.splitlines()) if piece}


def word_pattern(pattern):
    """`pattern` compiled, with the library's meaning of white space."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def _connect(ranks):
    """A database in memory with the table `vocab`. Its work is cut into bounded queries, so it has no spill folder."""
    con = duckdb.connect(config={"threads": 1, "temp_directory": "", "memory_limit": "1GB"})
    con.execute("set enable_progress_bar = false")
    vocab = pa.table(
        {
            "id": pa.array(list(ranks.values()), pa.int32()),
            "hex": pa.array([piece.hex() for piece in ranks]),
            "piece": pa.array(list(ranks), pa.binary()),
        }
    )
    con.register("given", vocab)
    con.execute("create table vocab as select * from given")
    con.unregister("given")
    return con


def _asked(con, name, rows, sql):
    """The Arrow result of `sql` over the Arrow table `rows`, seen as `name`."""
    con.register(name, rows)
    found = con.sql(sql).to_arrow_table().combine_chunks()
    con.unregister(name)
    return found


def _grouped(words):
    """Lists of words of at most `QUERY_BYTES` together; a longer word stands alone."""
    group, size = [], 0
    for word in words:
        if group and size + len(word) > QUERY_BYTES:
            yield group
            group, size = [], 0
        group.append(word)
        size += len(word)
    if group:
        yield group


class _Slots(dict):
    """Numbers of words; a new word gets the next one."""

    def __missing__(self, word):
        self[word] = slot = len(self)
        return slot


class WordEncoder:
    """Token ids of texts; remembers the words it has met."""

    def __init__(self, ranks, pattern):
        self.find = word_pattern(pattern).findall
        self.ranks = ranks
        self.con = _connect(ranks)
        self.con.execute(MERGES)
        self.reach = max(map(len, ranks))
        self.long = ENCODE_LONG.format(best=NEAREST.format(back=self.reach, ahead=2 * self.reach))
        singles = [bytes([b]) for b in range(256)]
        self.single = np.array([ranks[s] for s in singles], np.int32)
        self.double = np.array([[ranks.get(left + right, NO_PIECE) for right in singles] for left in singles], np.int32)
        self._forget()

    def _forget(self):
        self.slots = _Slots()
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def _learn(self, words):
        """Encode new words, which have the slots behind those of the words known."""
        pieces, short, long = [], [], []
        for number, word in enumerate(words):
            data = word.encode()
            kind = pieces if data in self.ranks else short if len(data) <= self.reach else long
            kind.append((number, data))
        numbers = np.array([number for number, _ in chain(pieces, short, long)], np.int64)
        got = [(np.ones(len(pieces), np.int64), np.array([self.ranks[data] for _, data in pieces], np.int32))]
        got += [self._asked(self._rows(group), ENCODE) for group in _grouped([data for _, data in short])]
        for group in _grouped([data for _, data in long]):
            rows = pa.table({"word": pa.array(range(len(group)), pa.int32()), "hex": [data.hex() for data in group]})
            got.append(self._asked(rows, self.long))
        sizes = np.concatenate([counts for counts, _ in got])
        starts = np.cumsum(sizes) - sizes + len(self.tokens)
        back = np.argsort(numbers)
        self.starts, self.sizes = np.concatenate([self.starts, starts[back]]), np.concatenate([self.sizes, sizes[back]])
        self.tokens = np.concatenate([self.tokens, *(tokens for _, tokens in got)])

    def _rows(self, group):
        """Words as lists of the mark and one token a byte, with the ranks of neighbours."""
        sizes = np.fromiter(map(len, group), np.int64, len(group))
        data = np.frombuffer(b"".join(group), np.uint8)
        offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
        token = np.ones(offsets[-1], bool)
        token[offsets[:-1]] = False
        toks = np.full(len(token), MARK, np.int32)
        toks[token] = self.single[data]
        ranks = np.full(len(token), NO_PIECE, np.int32)
        followed = np.flatnonzero(token[:-1] & token[1:])
        values = np.zeros(len(token), np.uint8)
        values[token] = data
        ranks[followed] = self.double[values[followed], values[followed + 1]]
        lists = [pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(v)) for v in (toks, ranks)]
        return pa.table({"word": pa.array(range(len(group)), pa.int32()), "toks": lists[0], "ranks": lists[1]})

    def _asked(self, rows, sql):
        """Numbers of tokens of the words, and the tokens."""
        toks = _asked(self.con, "words", rows, sql).column("toks").combine_chunks()
        return np.diff(toks.offsets.to_numpy()).astype(np.int64), toks.flatten().to_numpy(zero_copy_only=False).astype(np.int32)

    def encode(self, texts):
        """Lists of ids, one for each text, as an Arrow array."""
        if len(self.slots) > REMEMBERED or len(self.tokens) > REMEMBERED_TOKENS:
            self._forget()
        found = [self.find(text) if text else [] for text in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        known = len(self.slots)
        words = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(found)), np.int64, counts.sum())
        if len(self.slots) > known:
            self._learn(list(islice(self.slots, known, None)))
        per_word = self.sizes[words]
        ends = np.cumsum(per_word)
        # Token j of the batch is token j minus its word's first one in the word's list.
        places = np.repeat(self.starts[words] - (ends - per_word), per_word) + np.arange(per_word.sum())
        bounds = np.concatenate([[0], np.cumsum(counts)])
        offsets = np.concatenate([[0], ends])[bounds].astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(self.tokens[places], pa.int32()))


class ByteDecoder:
    """Bytes of lists of ids."""

    def __init__(self, ranks):
        self.con = _connect(ranks)

    def decode(self, lists):
        """The bytes of each list of an Arrow array; null where the list is, or holds an id that is no piece."""
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ids = lists.flatten()
        owner = np.repeat(np.arange(len(lists)), sizes)
        parts, lost = [[] for _ in range(len(lists))], set()
        for start in range(0, len(ids), QUERY_TOKENS):
            some = ids.slice(start, QUERY_TOKENS)
            rows = pa.table({"pos": np.arange(len(some), dtype=np.int32), "id": some})
            got = _asked(self.con, "tokens", rows, DECODE).column("piece").combine_chunks().cast(pa.binary())
            owners = owner[start : start + len(some)]
            lost.update(owners[got.is_null().to_numpy(zero_copy_only=False)].tolist())
            # The pieces of a text lie behind each other in one buffer.
            got = got.fill_null(b"")
            ends = np.concatenate([[0], np.cumsum(pc.binary_length(got).to_numpy(), dtype=np.int64)])
            data = pc.binary_join(pa.ListArray.from_arrays([0, len(got)], got), b"")[0].as_py()
            firsts = np.flatnonzero(np.diff(owners, prepend=-1))
            for first, last in zip(firsts.tolist(), [*firsts[1:].tolist(), len(owners)]):
                parts[owners[first]].append(data[ends[first] : ends[last]])
        valid = lists.is_valid().to_pylist()
        whole = [b"".join(p) if valid[i] and i not in lost else None for i, p in enumerate(parts)]
        return pa.array(whole, pa.binary())


def _checked(ranks):
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"The vocabulary lacks {len(missing)} single bytes, the first is {missing[0]}.")
    return ranks


def encode(df, ranks, pattern, id_col="doc_id", text_col="text"):
    """`id_col` and `ids` (array of int) of each row of `df`; a null text counts as empty and gives no ids.

    `ranks` maps pieces to ranks and must hold every single byte; it travels with
    the tasks. Special tokens are ordinary text. Rows are kept one to one,
    repeated rows and null ids too; other columns are left out, whatever their
    names. Texts are taken whole whatever their length.
    """
    _checked(ranks)

    def run(batches):
        encoder = WordEncoder(ranks, pattern)
        for batch in batches:
            ids = encoder.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["key", "ids"])

    key = df.schema[id_col].dataType.simpleString()
    narrow = df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"key {key}, ids array<int>").withColumnRenamed("key", id_col)


def decode(df, ranks, id_col="doc_id", ids_col="ids"):
    """`id_col`, `ids` and `decoded` (binary) of each row of `df`.

    The bytes are null where the list is null or holds a null or an id that is
    no piece. They need not be valid UTF-8, as a list may end inside a character.
    """

    def run(batches):
        decoder = ByteDecoder(ranks)
        for batch in batches:
            decoded = decoder.decode(batch.column(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], names=["key", "ids", "decoded"])

    key = df.schema[id_col].dataType.simpleString()
    narrow = df.select(F.col(id_col).alias("key"), F.col(ids_col).alias("ids"))
    return narrow.mapInArrow(run, f"key {key}, ids array<int>, decoded binary").withColumnRenamed("key", id_col)


@query("op11_byte_pairs")
def op11_byte_pairs(spark, sf_dir):
    """All documents encoded by the public multilingual ranks and decoded again."""
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = read_ranks(file.read())
    coded = encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return decode(coded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
