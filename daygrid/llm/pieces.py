"""SentencePiece encoding and decoding with a merge-type prefix table."""

from __future__ import annotations

from collections import Counter
from functools import lru_cache
from hashlib import sha256

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.llm.common import WordCache, per_row
from daygrid.llm.subwords import NONE, SPACE, Vocabulary, vocabulary

EMPTY = sha256(b"").hexdigest()


class PieceCodec:
    """Encodes by prefixes: the encoding of every prefix of a unit ends in one token.

    That token is the only one that an automaton finds to end there, that encodes to itself
    and that is compatible with the last token of the prefix before it, which is to say that
    the two, put together, merge to just these two. Ids are recovered from the end.
    """

    def __init__(self, model: Vocabulary):
        self.model = model
        self.whole = {p for p in model.ids if model.merge(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for piece in self.whole:
            if len(piece) > 1:
                self.automaton.add_word(piece, len(piece))
        if len(self.automaton):
            self.automaton.make_automaton()
        counts = Counter(model.scores[p] for p in model.ids)
        self.tied = {p for p in model.ids if counts[model.scores[p]] > 1}
        self.heads = WordCache(lambda p: self._growth(p, 0), len(model.ids) + 10_000)
        self.tails = WordCache(lambda p: self._growth(p, 1), len(model.ids) + 10_000)
        self.pairs = WordCache(lambda p: self.compatible(p[0][: -p[1]], p[0][-p[1] :]), 250_000)
        self.by_unit = WordCache(self._unit, 500_000)
        self.by_chunk = WordCache(self._chunk, 200_000)

    def _growth(self, piece: str, side: int) -> list[tuple[str, float]] | None:
        """A token's part at one edge as merging makes it grow, each with the score it grows at.

        None where scores don't tell the order: they are tied or rise while a token is made.
        """
        scores, steps = self.model.scores, []
        while len(piece) > 1:
            if piece in self.tied:
                return None
            steps.append((piece, scores[piece]))
            parts = self._parts(piece)
            if parts is None or any(len(p) > 1 and scores[p] <= scores[piece] for p in parts):
                return None
            piece = parts[side]
        steps.append((piece, 0.0))
        return steps[::-1]

    def _parts(self, piece: str) -> tuple[str, str] | None:
        """The two tokens whose merge makes a token, found without that merge."""
        score = self.model.scores.pop(piece)
        try:
            left = self.model.merge(piece)
        finally:
            self.model.scores[piece] = score
        return (left[0], left[1]) if len(left) == 2 else None

    def compatible(self, first: str, second: str) -> bool:
        """Whether two tokens, put together, merge to just these two.

        The token parts at the seam grow in order of score; the tokens stay apart exactly if
        no merge across the seam has its turn before the next growth. At equal scores the one
        further left comes first.
        """
        tail, head = self.tails[first], self.heads[second]
        if tail is None or head is None:
            return self.model.merge(first + second) == [first, second]
        score = self.model.scores.get
        i = j = 0
        end_i, end_j = len(tail) - 1, len(head) - 1
        while True:
            across = score(tail[i][0] + head[j][0])
            grow_i = tail[i + 1][1] if i < end_i else NONE
            grow_j = head[j + 1][1] if j < end_j else NONE
            if across is not None and across > grow_i and across >= grow_j:
                return False
            if grow_i == grow_j == NONE:
                return True
            if grow_i >= grow_j:
                i += 1
            else:
                j += 1

    def symbols(self, unit: str) -> list[str]:
        """The tokens of a unit, characters outside the vocabulary among them."""
        size = len(unit)
        if size == 1:
            return [unit]
        ending: list[list[int]] = [[] for _ in range(size)]
        if len(self.automaton):
            for end, length in self.automaton.iter(unit):
                ending[end].append(length)
        last = [0] * (size + 1)
        pairs = self.pairs
        for end in range(1, size + 1):
            matches = ending[end - 1]
            matches.append(1)
            for length in matches:
                start = end - length
                if not start or pairs[unit[start - last[start] : end], length]:
                    last[end] = length
                    break
            else:
                raise ValueError(f"no last token for a prefix of {unit!r}")
        out = []
        end = size
        while end:
            out.append(unit[end - last[end] : end])
            end -= last[end]
        return out[::-1]

    def _ids(self, unit: str) -> list[int]:
        return [i for s in self.symbols(unit) for i in self.model.symbol_ids(s)]

    def _unit(self, unit: str) -> tuple[int, str, str]:
        """Number of ids, the ids as text and the text that they decode to."""
        ids = self._ids(unit)
        return len(ids), "".join([f"{i}," for i in ids]), self.decoded(ids)

    def _chunk(self, chunk: str) -> tuple[int, str, str]:
        units = self.model.units(chunk)
        if len(units) == 1:
            return self.by_unit[units[0]]
        n, ids, texts = zip(*map(self.by_unit.__getitem__, units), strict=True)
        return sum(n), "".join(ids), "".join(texts)

    def encode(self, text: str) -> list[int]:
        return [
            i for c in self.model.chunks(text) for unit in self.model.units(c) for i in self._ids(unit)
        ]

    def decoded(self, ids: list[int]) -> str:
        """Text of ids, with the space that encoding puts in front of everything."""
        out, raw = [], bytearray()
        byte_of = self.byte_of
        for i in ids:
            if i in byte_of:
                raw.append(byte_of[i])
                continue
            if raw:
                out.append(_utf8(raw))
                raw = bytearray()
            out.append(self.model.pieces.get(i, ""))
        if raw:
            out.append(_utf8(raw))
        return "".join(out).replace(SPACE, " ")

    @property
    def byte_of(self) -> dict[int, int]:
        if not hasattr(self, "_byte_of"):
            self._byte_of = {i: b for b, i in self.model.byte_ids.items()}
        return self._byte_of

    def decode(self, ids: list[int]) -> str:
        text = self.decoded(ids)
        return text[1:] if text.startswith(" ") else text

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids and of the text decoded from them."""
        chunks = self.model.chunks(text)
        if not chunks:
            return 0, EMPTY, EMPTY
        n, ids, texts = zip(*map(self.by_chunk.__getitem__, chunks), strict=True)
        decoded = "".join(texts)[1:]  # without the space that encoding put in front
        return (
            sum(n),
            sha256("".join(ids)[:-1].encode()).hexdigest(),
            sha256(decoded.encode("utf-8")).hexdigest(),
        )


def _utf8(raw: bytearray) -> str:
    """Decoded bytes; each byte that is part of no character gives one replacement character."""
    out, at = [], 0
    while at < len(raw):
        for width in (1, 2, 3, 4):
            try:
                out.append(bytes(raw[at : at + width]).decode("utf-8"))
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """The codec of a model file, made once for each process."""
    return PieceCodec(vocabulary(path))


def encode_decode(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row; a null text is empty.

    Empty texts have no ids and digests of the empty string. Whole texts are encoded, in
    memory that is linear in a text. Rows that repeat give rows that repeat.
    """

    def make(batch):
        digests = codec(path).digests
        made = [digests(t or "") for t in batch.column(1).to_pylist()]
        n, ids, texts = zip(*made, strict=True) if made else ((), (), ())
        return {"doc_id": batch.column(0), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": texts}

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return per_row(source, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", make)
