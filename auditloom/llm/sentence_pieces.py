"""SentencePiece encoding and decoding on the tokenizers library.

The model file is parsed and rebuilt as a tokenizer: its normaliser as text
replacements with the space marker in front, its pieces as a unigram model with
scores or as a byte-pair model whose merges are ordered by score, and its byte
fallback. Where no piece reaches across a space, a batch's texts are cut before
each run of spaces and only cuts not yet seen by the task are encoded, as one
multithreaded batch. Each cut a task has not seen (or else each text) is also
encoded by the sentencepiece library and decoded again: `parity` tells whether
all of a text agreed, `round_trip` whether all of it came back. Where a cut
disagrees, the ids of the sentencepiece library are taken, and `parity` still
says false.
"""

import re
from array import array
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from auditloom.llm import model_file
from auditloom.llm.common import query, table

#: Cuts whose ids a task remembers at a time.
REMEMBERED = 600_000
#: Longer cuts are rare and not remembered.
REMEMBERED_CHARS = 64
#: Cuts that are encoded as one text.
GROUP = 512


def rebuild(model):
    """A `Tokenizer` that encodes as the parsed model does; spaces are expected as they are."""
    if model_file.USER_DEFINED in model.types or model_file.UNUSED in model.types:
        raise ValueError("User-defined and unused pieces are not supported.")
    space, ids = model_file.SPACE, model.ids()
    unknown = model.types.index(model_file.UNKNOWN)
    if model.kind == model_file.UNIGRAM:
        core = models.Unigram(list(zip(model.pieces, model.scores)), unk_id=unknown, byte_fallback=model.byte_fallback)
    elif model.kind == model_file.BPE:
        pieces, merges = model.mergeable(), []
        for piece in sorted(pieces, key=lambda p: (-pieces[p], ids[p])):
            cuts = [(piece[:i], piece[i:]) for i in range(1, len(piece))]
            merges += sorted((c for c in cuts if c[0] in pieces and c[1] in pieces), key=lambda c: (ids[c[0]], ids[c[1]]))
        core = models.BPE(
            ids, merges, byte_fallback=model.byte_fallback, unk_token=model.pieces[unknown], fuse_unk=True
        )
    else:
        raise ValueError("Only unigram and byte-pair models are supported.")
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.trim:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(space))
    if model.escape:
        steps.append(normalizers.Replace(" ", space))
    tokenizer.normalizer = normalizers.Sequence(steps)
    ends = [decoders.Replace(space, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        ends.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(ends)
    return tokenizer


class Codec:
    """Encodes and decodes batches of texts within one task.

    Ids are handled as the bytes of 32-bit numbers, so that what is remembered
    stays small and a text's ids are its cuts' joined.
    """

    def __init__(self, data):
        model = model_file.parse(data)
        self.tokenizer = rebuild(model)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        plain = not model.charsmap and not model.trim and model.dummy_prefix and model.escape
        self.cutting = plain and model_file.splits_at_spaces(model)
        # The marker itself counts as a space, as it does once spaces are escaped.
        space = f"[ {model_file.SPACE}]"
        self.cut = re.compile(f"{space}*[^ {model_file.SPACE}]+|{space}+")
        #: Bytes of escaped text that each piece stands for.
        self.lengths = np.array([1 if t == model_file.BYTE else len(p.encode()) for p, t in zip(model.pieces, model.types)])
        self.seen, self.differing, self.changed = {}, set(), set()

    def _compared(self, texts):
        """(ids as lists, whether the sentencepiece library agrees) of each text."""
        mine = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        theirs = self.library.encode(texts, num_threads=1)
        return [(b, a == b) for a, b in zip(mine, theirs)]

    def encode(self, texts):
        """(ids as bytes, parity, round trip) of each text; none for an empty or null one."""
        texts = [t or "" for t in texts]
        if not self.cutting:
            made = [(packed(ids), alike) for ids, alike in self._compared(texts)]
            back = self.decode([unpacked(ids) for ids, _ in made])
            return [(ids, alike, b == t) for (ids, alike), b, t in zip(made, back, texts)]
        # Behind the marker that the model puts in front, each cut begins with a
        # space; without that first one it is a text of its own.
        cuts = [self.cut.findall(" " + t) if t else [] for t in texts]
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        seen, fresh = self.seen, {}
        new = list({c for cut in cuts for c in cut if c not in seen})
        for cut, ids in zip(new, self._cuts(new)):
            (seen if len(cut) <= REMEMBERED_CHARS else fresh)[cut] = ids
        take = {**seen, **fresh} if fresh else seen
        return [
            (b"".join([take[c] for c in cut]), self.differing.isdisjoint(cut), self.changed.isdisjoint(cut))
            for cut in cuts
        ]

    def _cuts(self, cuts):
        """Ids of each cut. Cuts whose ids the libraries see differently go to
        `differing`, those that do not come back from their ids to `changed`.

        Cuts keep their pieces when joined, unless they are spaces only, so they
        are encoded and decoded in joined groups; a group in which anything
        differs is done cut by cut.
        """
        spaces = " " + model_file.SPACE
        worded = [c for c in cuts if c.strip(spaces)]
        groups = [worded[i : i + GROUP] for i in range(0, len(worded), GROUP)]
        joined = ["".join(group)[1:] for group in groups]
        mine = [e.ids for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        theirs = self.library.encode(joined, num_threads=1)
        back = self.tokenizer.decode_batch(mine, skip_special_tokens=False)
        found, alone = {}, [c for c in cuts if not c.strip(spaces)]
        for group, text, ids, other, again in zip(groups, joined, mine, theirs, back):
            parts = self._parted(group, ids) if ids == other and again == text else None
            if parts is None:
                alone += group
            else:
                found.update(zip(group, parts))
        for cut in alone:
            found[cut] = self._alone(cut)
        return [found[c] for c in cuts]

    def _parted(self, cuts, ids):
        """The ids of joined cuts by cut; none if some piece lies across two cuts."""
        ids = np.array(ids, np.int32)
        ends = np.cumsum([len(c.replace(" ", model_file.SPACE).encode()) for c in cuts])
        reached = np.cumsum(self.lengths[ids])
        last = np.searchsorted(reached, ends)
        if last[-1] >= len(reached) or not np.array_equal(reached[last], ends):
            return None
        data, ends = ids.tobytes(), ((last + 1) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _alone(self, cut):
        """Ids of one cut, compared and decoded by itself."""
        # Without its first space a cut is a text of its own, but a lone space
        # is a piece behind a text and no text has only that piece.
        text, lone = cut[1:], [self.library.piece_to_id(model_file.SPACE)]
        mine = self.tokenizer.encode(text, add_special_tokens=False).ids if text else lone
        theirs = self.library.encode(text) if text else lone
        if mine != theirs:
            self.differing.add(cut)
        # A text in front keeps the decoder from taking the first space away.
        front = self.library.encode("a")
        if self.tokenizer.decode(front + theirs, skip_special_tokens=False) != "a" + cut:
            self.changed.add(cut)
        return packed(theirs)

    def decode(self, ids):
        """The text of each list of ids."""
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def packed(ids):
    """A list of ids as bytes."""
    return array("i", ids).tobytes()


def unpacked(data):
    """The list of ids in bytes."""
    return array("i", data).tolist()


def _id_lists(made):
    """An Arrow list array of ids given as bytes."""
    sizes = [len(m) // 4 for m in made]
    offsets = pa.array([0, *accumulate(sizes)], pa.int32())
    values = pa.Array.from_buffers(pa.int32(), sum(sizes), [None, pa.py_buffer(b"".join(made))])
    return pa.ListArray.from_arrays(offsets, values)


def _mapped(df, names, types, data, step):
    """`df` under `step(codec, batch)`, which gives arrays for the columns `names`."""

    def run(batches):
        codec = Codec(data)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(step(codec, batch), names=names)

    return df.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, types)))


def encode(df, data, id_col="doc_id", text_col="text"):
    """`id_col`, `ids` (array of int), `parity` and `round_trip` of each row.

    `data` holds the bytes of the model file. Null texts count as empty and have
    no ids. Rows are kept one to one; other columns are left out, whatever
    their names. `round_trip` is whether the decoded ids are the text.
    """

    def step(codec, batch):
        made = codec.encode(batch.column(1).to_pylist())
        return [batch.column(0), _id_lists([m[0] for m in made]), *[pa.array([m[k] for m in made]) for k in (1, 2)]]

    key = df.schema[id_col].dataType.simpleString()
    narrow = df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    names, types = ["key", "ids", "parity", "round_trip"], [key, "array<int>", "boolean", "boolean"]
    return _mapped(narrow, names, types, data, step).withColumnRenamed("key", id_col)


def decode(df, data, id_col="doc_id", ids_col="ids"):
    """`id_col` and the `text` that each row's ids stand for; empty for null ids."""

    def step(codec, batch):
        return [batch.column(0), pa.array(codec.decode([i or [] for i in batch.column(1).to_pylist()]), pa.string())]

    key = df.schema[id_col].dataType.simpleString()
    narrow = df.select(F.col(id_col).alias("key"), F.col(ids_col).alias("ids"))
    return _mapped(narrow, ["key", "text"], [key, "string"], data, step).withColumnRenamed("key", id_col)


def public_model():
    """Bytes of the public 32k model."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def encoded_digest(documents):
    """The digest columns that the query and the pipeline return."""
    return encode(documents, public_model()).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        "round_trip",
        "parity",
    )


@query("op9_sentence_pieces")
def op9_sentence_pieces(spark, sf_dir):
    """All documents encoded, decoded and compared: count and digest of the ids."""
    return encoded_digest(table(spark, sf_dir, "documents"))
