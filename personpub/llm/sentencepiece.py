"""SentencePiece encoding and decoding: Viterbi over a stream of characters."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import small_batches, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: stands for a U+2581 of the text itself; no text holds a lone surrogate
MARK = "\udfff"
#: words up to this length, and pairs of pieces, are remembered, at most so many of each
CHUNK, REMEMBERED = 48, 1_000_000
#: characters between two looks for a common boundary
STRIDE = 256
NEVER = float("-inf")
BYTES = re.compile("[\udc80-\udcff]")
WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")


def _steps(chars: str) -> Iterator[str]:
    """A long text in parts of STRIDE characters."""
    return (chars[i : i + STRIDE] for i in range(0, len(chars), STRIDE))


class Pieces:
    """The pieces of a model file with their scores, and both directions of coding.

    A text is coded as a space and itself, with spaces as U+2581. A character that is no piece
    becomes the pieces of its UTF-8 bytes; so does a U+2581 of the text itself, so that
    decoding gives back the text exactly. The empty text has no ids.

    Of all splits into pieces, a model of likelihoods takes the one with the largest sum of
    scores; of equal ones, the one whose last piece is longest, and so on backwards. In a model
    of merges scores are ranks. There a piece may follow another only if merging the two
    together, best rank first, gives back just these two; one split meets that everywhere, that of
    merging the whole text, so that a single path ends at every boundary.
    """

    def __init__(self, model: str = MODEL, merges: bool | None = None):
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=model)
        ids = range(p.get_piece_size())
        plain = [i for i in ids if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
        self.scores = {p.id_to_piece(i): (p.get_score(i), i) for i in plain}
        self.text = {i: t for t, (_, i) in self.scores.items()}
        #: by character: the piece that ends here or None, and the characters that may follow
        self.trie: dict = {}
        for t, piece in self.scores.items():
            below = self.trie
            for c in t:
                node = below.setdefault(c, [None, {}])
                below = node[1]
            node[0] = piece
        self.bytes = {int(p.id_to_piece(i)[3:5], 16): i for i in ids if p.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        # bytes of longer characters are shown as lone surrogates until all are together
        self.shown = {i: t.replace(SPACE, " ") for i, t in self.text.items()}
        self.shown |= {i: chr(b) if b < 0x80 else chr(0xDC00 + b) for i, b in self.byte_of.items()}
        if len(self.bytes) < 256:
            raise ValueError(f"{model} has no pieces for single bytes")
        self.longest = max(map(len, self.scores))
        self.fallback = min(s for s, _ in self.scores.values()) - 10.0
        #: if no piece goes on over the end of a word, all paths meet there
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.scores)
        #: likelihoods are logarithms; whole numbers are places in an order of merges
        self.merges = all(s == int(s) for s, _ in self.scores.values()) if merges is None else merges
        self.known: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.told = 0

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        chars = (" " + text.replace(SPACE, MARK)).replace(" ", SPACE)
        if not self.cuts:
            return list(self.stream(_steps(chars)))
        # all paths meet at the end of a word, so what the stream gives for a word holds anywhere
        out: list[int] = []
        known = self.known
        for found in WORDS.finditer(chars):
            word = found[0]
            ids = known.get(word)
            if ids is None:
                if len(word) > CHUNK:
                    out += self.stream(_steps(word))
                    continue
                if len(known) >= REMEMBERED:
                    known.clear()
                ids = known[word] = tuple(self.stream((word,)))
            out += ids
        return out

    def _merged(self, text: str) -> list[str]:
        """A short text after all merges: always the best pair of neighbours, of equal ones the first."""
        parts = list(text)
        while True:
            top, at = NEVER, -1
            for k in range(len(parts) - 1):
                piece = self.scores.get(parts[k] + parts[k + 1])
                if piece is not None and piece[0] > top:
                    top, at = piece[0], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, before: int, piece: int) -> bool:
        """Whether a piece may stand behind another (-1: behind what merges with nothing)."""
        if self.told >= REMEMBERED:
            for row in self.pairs.values():
                row.clear()
            self.told = 0
        pair = [self.text[i] for i in (before, piece) if i >= 0]
        may = self._merged("".join(pair)) == pair
        self.pairs.setdefault(before, {})[piece] = may
        self.told += 1
        return may

    def _carry(self, window: str, best: list[float], back: list[int], ids: list[int], at: int, end: int) -> None:
        """Carry the positions from `at` on over every piece that may begin there."""
        trie, n, follows = self.trie, len(window), self.follows
        for i in range(at, end):
            node, j = trie.get(window[i]), i + 1
            if self.merges:
                before = ids[i]
                row = self.pairs.get(before)
                if row is None:
                    row = self.pairs[before] = {}
                if node is None or node[0] is None:
                    best[j], back[j], ids[j] = 0.0, i, -1
                while node is not None:
                    piece = node[0]
                    if piece is not None:
                        one = piece[1]
                        if row[one] if one in row else follows(before, one):
                            best[j], back[j], ids[j] = 0.0, i, one
                    if j == n:
                        break
                    node = node[1].get(window[j])
                    j += 1
                continue
            score = best[i]
            if score + self.fallback > best[j]:
                best[j], back[j], ids[j] = score + self.fallback, i, -1
            while node is not None:
                piece = node[0]
                if piece is not None and score + piece[0] > best[j]:
                    best[j], back[j], ids[j] = score + piece[0], i, piece[1]
                if j == n:
                    break
                node = node[1].get(window[j])
                j += 1

    def stream(self, parts: Iterable[str]) -> Iterator[int]:
        """The ids of a stream of characters, or of longer parts of a text, each as soon as it is settled.

        A position is carried on once the `longest` characters after it are there, so paths
        beyond that window do not exist yet. Backpointers are kept from the last settled
        boundary; whenever the paths of all positions that can still be extended go through
        one boundary, the ids up to it are given out.
        """
        window, at = "", 0  # characters from the settled boundary on; the position to be carried on
        best, back, ids = [0.0], [0], [-1]
        for part in parts:
            window += part
            best += [NEVER] * len(part)
            back += [0] * len(part)
            ids += [-1] * len(part)
            while len(window) - at >= self.longest:
                end = min(at // STRIDE * STRIDE + STRIDE, len(window) - self.longest + 1)
                self._carry(window, best, back, ids, at, end)
                at = end
                if at % STRIDE == 0:
                    meet = self._meeting(best, back, at)
                    if meet:
                        yield from self._path(window, back, ids, meet)
                        window, best, at = window[meet:], best[meet:], at - meet
                        back, ids = [max(0, b - meet) for b in back[meet:]], ids[meet:]
        self._carry(window, best, back, ids, at, len(window))
        yield from self._path(window, back, ids, len(window))

    @staticmethod
    def _meeting(best: list[float], back: list[int], at: int) -> int:
        """The last boundary that the paths of all positions reached so far share."""
        live = {i for i in range(at, len(best)) if best[i] > NEVER}
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(back[last])
        return live.pop()

    def _path(self, window: str, back: list[int], ids: list[int], end: int) -> list[int]:
        out: list[int] = []
        while end:
            if ids[end] >= 0:
                out.append(ids[end])
            else:
                c = SPACE if window[end - 1] == MARK else window[end - 1]
                out += [self.bytes[b] for b in reversed(c.encode("utf-8", "surrogatepass"))]
            end = back[end]
        return out[::-1]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; ids that are no piece give nothing, broken bytes U+FFFD."""
        text = "".join([self.shown.get(i, "") for i in ids])
        if not text.isascii() and BYTES.search(text):
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_loaded: dict[str, Pieces] = {}


def pieces(model: str = MODEL) -> Pieces:
    if model not in _loaded:
        _loaded[model] = Pieces(model)
    return _loaded[model]


def encode(text: Column, model: str = MODEL) -> Column:
    """Ids of a text, array<int>; an empty array for a null or empty text."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        p = pieces(model)
        return pd.Series([p.encode(t) for t in texts], dtype=object)

    return ids(text)


def decode(ids: Column, model: str = MODEL) -> Column:
    """The text of ids; '' for null or no ids."""

    @F.pandas_udf("string")
    def texts(lists: pd.Series) -> pd.Series:
        p = pieces(model)
        return pd.Series([p.decode(x) if x is not None else "" for x in lists], dtype=object)

    return texts(ids)


def coded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, n_ids, ids_sha256, n_fallback, text_sha256, round_trip.

    Whole texts are coded and decoded again in the task that reads them; nothing is
    shuffled. ids_sha256 is over the ids as 32-bit little-endian numbers, text_sha256 over the
    decoded text, and round_trip says whether that is the text, null counting as empty.
    n_fallback counts ids that stand for single bytes. Null ids pass through, repeated
    rows each give a row, other columns are not read, an empty table gives no rows.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pieces(model)
        for batch in batches:
            rows = []
            for key, text in zip(batch["doc_id"], batch["text"]):
                text = text or ""
                ids = p.encode(text)
                again = p.decode(ids)
                rows.append(
                    (
                        key,
                        len(ids),
                        hashlib.sha256(array("I", ids).tobytes()).hexdigest(),
                        sum(map(p.byte_of.__contains__, ids)),
                        hashlib.sha256(again.encode("utf-8", "surrogatepass")).hexdigest(),
                        again == text,
                    )
                )
            yield pd.DataFrame(rows, columns=NAMES)

    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = dict(docs.dtypes)[id_col]
    out = rows.mapInPandas(
        run,
        "doc_id string, n_ids long, ids_sha256 string, n_fallback long, text_sha256 string, round_trip boolean",
    )
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


NAMES = ["doc_id", "n_ids", "ids_sha256", "n_fallback", "text_sha256", "round_trip"]


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents"))
