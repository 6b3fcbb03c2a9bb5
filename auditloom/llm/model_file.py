"""The parts of a SentencePiece model file that encoding needs.

The file is a protocol buffer message. Only its wire format is read here: field
numbers with varint, fixed or length-delimited values.
"""

import struct
from dataclasses import dataclass, field

# Field numbers and enumerations of the published message format.
MODEL_PIECE, MODEL_TRAINER, MODEL_NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
TRAINER_TYPE, TRAINER_BYTE_FALLBACK, TRAINER_SUFFIX = 3, 35, 24
UNIGRAM, BPE = 1, 2
NORMALIZER_MAP, NORMALIZER_PREFIX, NORMALIZER_TRIM, NORMALIZER_ESCAPE = 2, 3, 4, 5
SPACE = "▁"


@dataclass
class Model:
    pieces: list = field(default_factory=list)
    scores: list = field(default_factory=list)
    types: list = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True
    charsmap: bytes = b""

    def ids(self):
        """Piece to identifier."""
        return {piece: i for i, piece in enumerate(self.pieces)}

    def mergeable(self):
        """Score by piece, of those that merging may form."""
        return {p: s for p, s, t in zip(self.pieces, self.scores, self.types) if t == NORMAL}


def _varint(data, at):
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data):
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        number, wire = key >> 3, key & 7
        if wire == 0:
            value, at = _varint(data, at)
        else:
            if wire == 2:
                size, at = _varint(data, at)
            else:
                size = {1: 8, 5: 4}[wire]
            value, at = data[at : at + size], at + size
        yield number, value


def parse(data):
    """The `Model` in the bytes of a model file."""
    model = Model()
    for number, value in _fields(data):
        if number == MODEL_PIECE:
            piece = dict(_fields(value))
            model.pieces.append(piece[PIECE_TEXT].decode())
            model.scores.append(struct.unpack("<f", piece.get(PIECE_SCORE, bytes(4)))[0])
            model.types.append(piece.get(PIECE_TYPE, NORMAL))
        elif number == MODEL_TRAINER:
            trainer = dict(_fields(value))
            model.kind = trainer.get(TRAINER_TYPE, UNIGRAM)
            model.byte_fallback = bool(trainer.get(TRAINER_BYTE_FALLBACK, 0))
            if trainer.get(TRAINER_SUFFIX, 0):
                raise ValueError("Models that treat white space as a suffix are not supported.")
        elif number == MODEL_NORMALIZER:
            spec = dict(_fields(value))
            model.charsmap = spec.get(NORMALIZER_MAP, b"")
            model.dummy_prefix = bool(spec.get(NORMALIZER_PREFIX, 1))
            model.trim = bool(spec.get(NORMALIZER_TRIM, 1))
            model.escape = bool(spec.get(NORMALIZER_ESCAPE, 1))
    return model


def splits_at_spaces(model):
    """Whether no piece has the space marker behind another character, so that
    text can be cut before each run of spaces without changing its pieces."""
    return not any(SPACE in p.lstrip(SPACE) for p in model.mergeable())
