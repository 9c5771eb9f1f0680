"""A merge-type subword vocabulary: which pieces it has and how adjacent pieces merge."""

from __future__ import annotations

import heapq
import re

SPACE = "▁"
_PARTS = re.compile(rf"{SPACE}*(?:\w+|[^\w{SPACE}]+)|{SPACE}+")
#: Characters up to which pairs are searched one by one.
SHORT = 64
NONE = float("-inf")
_RUNS = re.compile(rf"{SPACE}+[^{SPACE}]*")


def _kind(char: str) -> int:
    if char == SPACE:
        return 0
    return 1 if re.match(r"\w", char) else 2


class Vocabulary:
    """Pieces, their scores and byte pieces of a sentencepiece merge model at ``path``."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        special = {i for i in range(size) if library.is_control(i) or library.is_unknown(i)}
        bytes_ = [i for i in range(size) if library.is_byte(i)]
        self.byte_ids = {int(library.id_to_piece(i)[3:5], 16): i for i in bytes_}
        normal = [i for i in range(size) if i not in special and not library.is_byte(i)]
        self.ids = {library.id_to_piece(i): i for i in normal}
        self.pieces = {i: p for p, i in self.ids.items()}
        self.scores = {p: library.get_score(i) for p, i in self.ids.items()}
        pairs = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        # Where no piece holds two adjacent characters, no merge crosses them. Pieces never have
        # a space mark after another character, and hardly any joins word and other characters.
        self.spaces_part = not any(b == SPACE and a != SPACE for a, b in pairs)
        # Where one does, its word character marks the chunks that aren't divided further.
        mixed = {(a, b) for a, b in pairs if _kind(a) and _kind(b) and _kind(a) != _kind(b)}
        self.tricky = frozenset(c for pair in mixed for c in pair if _kind(c) == 1)

    def chunks(self, text: str) -> list[str]:
        """Parts of a text that merge apart, each without the space mark that it begins with."""
        if not text:
            return []
        marked = text.replace(" ", SPACE)
        if not self.spaces_part:
            return [marked]
        found = marked.split(SPACE)
        if "" not in found:
            return found
        return [run[1:] for run in _RUNS.findall(SPACE + marked)]

    def units(self, chunk: str) -> list[str]:
        """Parts of a chunk, with its space mark, that merge apart."""
        marked = SPACE + chunk
        if not self.spaces_part or not self.tricky.isdisjoint(chunk):
            return [marked]
        return _PARTS.findall(marked)

    def merge(self, unit: str) -> list[str]:
        """The symbols that are left when the best adjacent pair has been merged again and again.

        The pair with the highest score goes first, of equal ones the leftmost.
        """
        if len(unit) > SHORT:
            return self._merge_long(unit)
        symbols = list(unit)
        score = self.scores.get
        pairs = [score(a + b, NONE) for a, b in zip(symbols, symbols[1:], strict=False)]
        while pairs:
            best = max(pairs)
            if best == NONE:
                break
            i = pairs.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = score(symbols[i] + symbols[i + 1], NONE)
            if i:
                pairs[i - 1] = score(symbols[i - 1] + symbols[i], NONE)
        return symbols

    def _merge_long(self, unit: str) -> list[str]:
        """``merge`` in n log n steps, with the pairs in a heap and the symbols linked."""
        symbols = list(unit)
        count = len(symbols)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            made = symbols[i] + symbols[j]
            if made in self.scores:
                heapq.heappush(heap, (-self.scores[made], i, j, made))

        for i in range(count - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, made = heapq.heappop(heap)
            # An emptied right end or a grown symbol makes an older offer void.
            if not symbols[j] or symbols[i] + symbols[j] != made or after[i] != j:
                continue
            symbols[i], symbols[j] = made, ""
            after[i] = after[j]
            if after[i] < count:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s in symbols if s]

    def symbol_ids(self, symbol: str) -> list[int]:
        """A piece's id, or the byte pieces of a character that is none."""
        known = self.ids.get(symbol)
        return [known] if known is not None else [self.byte_ids[b] for b in symbol.encode("utf-8")]


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary at ``path``, loaded once for each process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]
