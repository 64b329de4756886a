"""Token counts by byte-pair merging, without making identifiers."""

from __future__ import annotations

import functools
import re
import string
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.caches import BoundedCache
from tickwatch.llm.frames import quoted, with_struct

SPACE = "▁"
CHUNKS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Signs that stand behind words.
SIGNS = string.punctuation
LIMIT = 4096
COLUMNS = ["n_bytes", "n_tokens", "over_limit"]


class Merges:
    """A vocabulary as numbers: which two pieces make which, and how early."""

    def __init__(self, ranks: dict[str, float]):
        self.numbers = {piece: number for number, piece in enumerate(ranks)}
        self.base = len(ranks) + 1  # the last number stands for any unknown character
        order = {rank: place for place, rank in enumerate(sorted(set(ranks.values())))}
        self.pairs: dict[int, tuple[int, int]] = {}
        for piece, number in self.numbers.items():
            for at in range(1, len(piece)):
                left, right = self.numbers.get(piece[:at]), self.numbers.get(piece[at:])
                if left is not None and right is not None:
                    self.pairs[left * self.base + right] = (order[ranks[piece]], number)

    def count(self, chunk: str) -> int:
        """Tokens of a chunk: its initial symbols minus the merges.

        Symbols sit in a linked list, adjacent pairs in a heap by rank, then place. A
        character outside the vocabulary counts as its UTF-8 bytes and never merges.
        """
        unknown, base, pair = self.base - 1, self.base, self.pairs.get
        number = self.numbers.get
        symbols = [number(char, unknown) for char in chunk]
        end = len(symbols)
        count = end
        if unknown in symbols:
            count += sum(len(char.encode()) - 1 for char, symbol in zip(chunk, symbols) if symbol == unknown)
        # An entry is rank * end + place, so that integers compare as (rank, place).
        heap = []
        for left, symbol in enumerate(symbols[1:]):
            if made := pair(symbols[left] * base + symbol):
                heap.append(made[0] * end + left)
        heapify(heap)
        following, before = list(range(1, end + 1)), list(range(-1, end - 1))
        while heap:
            rank, left = divmod(heappop(heap), end)
            right = following[left]
            # An entry is stale once either side has been merged with another.
            if right == end or symbols[left] < 0:
                continue
            made = pair(symbols[left] * base + symbols[right])
            if made is None or made[0] != rank:
                continue
            symbol = symbols[left] = made[1]
            symbols[right] = -1
            count -= 1
            following[left] = after = following[right]
            if after < end:
                before[after] = left
                if made := pair(symbol * base + symbols[after]):
                    heappush(heap, made[0] * end + left)
            previous = before[left]
            if previous >= 0 and (made := pair(symbols[previous] * base + symbol)):
                heappush(heap, made[0] * end + previous)
        return count


class Counter:
    """Counts the tokens of texts for one sentencepiece BPE vocabulary with byte fallback."""

    def __init__(self, ranks: dict[str, float]):
        self.merges = Merges(ranks)
        # Two characters that stand side by side in no piece are never merged over,
        # so a text may be cut between them.
        self.joined = {piece[at : at + 2] for piece in ranks for at in range(len(piece) - 1)}
        self.cut_at_spaces = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.joined)
        self.newline_alone = not any("\n" in piece for piece in ranks)
        self.counts = BoundedCache(self.count_chunk)
        self.parts = BoundedCache(self.merges.count)

    def count_chunk(self, chunk: str) -> int:
        word = chunk.rstrip(SIGNS)
        at = len(word)
        if 0 < at < len(chunk) and chunk[at - 1 : at + 1] not in self.joined:
            return self.parts[word] + self.parts[chunk[at:]]
        return self.parts[chunk]

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        escaped = SPACE + text.replace(" ", SPACE)
        if not self.cut_at_spaces:
            return self.merges.count(escaped)
        count = self.counts.__getitem__
        if SPACE * 2 in escaped or not self.newline_alone:
            return sum(count(found[0]) for found in CHUNKS.finditer(escaped))
        # Line ends stand outside the vocabulary: one byte each, and no merges over them.
        chunks = escaped.replace(SPACE, " " + SPACE).replace("\n", " ").split(" ")
        return text.count("\n") + sum(map(count, chunks))


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """The counter for a model file, made once in each worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks = {}
    for number in range(model.get_piece_size()):
        if not (model.is_byte(number) or model.is_control(number) or model.is_unknown(number)):
            ranks[model.id_to_piece(number)] = -model.get_score(number)
    return Counter(ranks)


def count_tokens(df: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Null counts as the empty text: 0 bytes and 0 tokens. Rows stay as they are,
    repeated rows too; same-named columns of the input are replaced. Whole texts are
    counted, with special strings as ordinary text. ``path`` names a sentencepiece
    BPE model with identity normalisation and byte fallback.
    """

    @F.arrow_udf("n_bytes bigint, n_tokens bigint, over_limit boolean")
    def counted(texts: pa.Array) -> pa.Array:
        count = counter(path)
        sizes, tokens = [], []
        for text in texts:
            text = text.as_py() or ""
            sizes.append(len(text.encode()))
            tokens.append(count(text))
        over = [n > limit for n in tokens]
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over, pa.bool_())], COLUMNS
        )

    return with_struct(df, counted(F.col(quoted(text_col)).cast("string")), COLUMNS)
