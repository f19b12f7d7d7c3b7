"""Exact token counts at every prefix of a text (operator 1).

The vocabulary is a BPE file of the ``tokenizers`` library whose normaliser,
splitter and merges are local to a word. Inside a word the counts come from a
prefix dynamic programme: the BPE encoding of ``s[:i]`` ends in the one token
``t`` for which (last token of ``s[:i-|t|]``, ``t``) is itself a stable pair,
so ``count[i] = count[i - |t|] + 1`` costs a few look-ups per prefix and no
prefix is ever encoded twice. Words add up, so one pass over a text gives the
exact count at each prefix; truncation and budget questions are answered from
the stored counts. Of a whole word only the prefixes are settled that lead to
its end, longest tokens first: a prefix has one encoding, so a prefix from
which the end was not reached is never looked at again.

Prefix positions are code points of the normalised text (``normalise``).

Defined cases: null text counts as empty (0 tokens); special token strings in
the text count as the library's default counts them (one token each); repeated
rows and repeated or null ids give one result row per input row; an empty
table gives an empty table; other columns of the input are not read.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

WORD_CACHE = 300_000  # words remembered per Python worker (memory bound only)
PAIR_CACHE = 400_000
CHUNK = 4096          # prefixes per row of the prefix table
END = "</w>"


class _Remembered(dict):
    """Values of a function, at most ``most`` at a time."""

    def __init__(self, fn, most: int):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.fn(key)
        return value


def _byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 byte values: printable Latin-1 bytes
    stand for themselves, the others for code points from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


BYTES = _byte_alphabet()
_SIMPLE_LIMIT = 0x250  # below: NFC-stable, same classes in every Unicode version


class PrefixCounter:
    """Counts of one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END:
            raise ValueError(f"{path}: a BPE vocabulary with word ends is needed")
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.right: dict[str, dict[str, int]] = {}  # the same by the left piece
        for (a, b), i in self.rank.items():
            self.right.setdefault(a, {})[b] = i
        # The merge that makes a token, of those its vocabulary lists first.
        self.made: dict[str, tuple[int, str, str]] = {}
        for (a, b), i in self.rank.items():
            self.made.setdefault(a + b, (i, a, b))
        self.edges: dict[tuple[str, bool], list] = {}
        self.vocab = frozenset(model["vocab"])
        opening = frozenset(t for t in self.vocab if not t.endswith(END))
        self.starts: dict[str, str] = {}  # beginnings of open tokens: the longest whole token in each
        for t in opening:
            whole = ""
            for i in range(1, len(t) + 1):
                whole = t[:i] if t[:i] in opening else whole
                self.starts.setdefault(t[:i], whole)
        self.closing = {t.removesuffix(END): t for t in self.vocab if t.endswith(END)}
        self.longest = max(len(t.removesuffix(END)) for t in self.vocab)
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))))
        # The file's splitting pattern, with its letter and number classes
        # spelled out for the simple range.
        by = {k: "".join(re.escape(chr(c)) for c in range(_SIMPLE_LIMIT + 0x100)
                         if unicodedata.category(chr(c))[0] == k) for k in "LN"}
        # (contractions, which begin with neither, stand after them here)
        contractions = "|".join(("s", "t", "re", "ve", "m", "ll", "d"))
        self.words = re.compile(f"[{by['L']}]+|[{by['N']}]|'(?:{contractions})|"
                                f"[^\\t-\\r \x85\xa0{by['L']}{by['N']}]+")
        self.beyond = re.compile(f"[^\\x00-{chr(_SIMPLE_LIMIT - 1)}]")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.cache = _Remembered(self.word, WORD_CACHE)

    # -- the programme inside a word ---------------------------------------

    def _edge(self, token: str, right: bool) -> list[tuple[str, int, int]]:
        """What stands at one edge of a token while it is merged: (piece, rank
        of the merge that makes it, rank of the merge that uses it up)."""
        chain = self.edges.get((token, right))
        if chain is None:
            chain, piece, used = [], token, 1 << 30
            while True:
                made = self.made.get(piece)
                chain.append((piece, -1 if made is None else made[0], used))
                if made is None:
                    break
                piece, used = made[2 if right else 1], made[0]
            self.edges[token, right] = chain
        return chain

    def _pair(self, a: str, b: str) -> bool:
        """Whether two tokens stay apart: no two pieces that stand at their
        common border at the same time merge. "" is the start of the word.
        Of equal merges the left one comes first, hence ``<`` and ``<=``."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            ok = self.pairs[a, b] = not a or self._apart(a, b)
        return ok

    def _apart(self, a: str, b: str) -> bool:
        left = self._edge(b, False)
        for x, made_x, used_x in self._edge(a, True):
            if ranks := self.right.get(x):
                for y, made_y, used_y in left:
                    r = ranks.get(y)
                    if r is not None and made_x < r < used_x and made_y < r <= used_y:
                        return False
        return True

    def _table(self, s: str) -> tuple[list, list[int]]:
        """Last token and token count of each proper prefix that goes on.

        From every prefix the open tokens that can follow are tried, shortest
        first, as long as some token starts with what has been read."""
        n, starts, pairs = len(s), self.starts, self.pairs
        last, count = [None] * (n + 1), [0] * (n + 1)
        last[0] = ""
        for j in range(n - 1):
            before, ended = last[j], count[j] + 1
            for i in range(j + 1, n):
                t = s[j:i]
                whole = starts.get(t)
                if whole is None:
                    break
                if whole == t and last[i] is None:
                    ok = pairs.get((before, t))
                    if self._pair(before, t) if ok is None else ok:
                        last[i], count[i] = t, ended
        return last, count

    def _closed(self, s: str, i: int, last: list, count: list[int]) -> int:
        """Tokens of the prefix of length i taken as a whole word."""
        vocab = self.vocab
        for j in range(max(0, i - self.longest), i):
            t = s[j:i] + END
            if t in vocab and self._pair(last[j], t):
                return count[j] + 1
        raise ValueError(f"no encoding of {s[:i]!r}")

    @staticmethod
    def _bytes(word: str) -> str:
        return word if word.isascii() else "".join([BYTES[b] for b in word.encode()])

    def word(self, word: str) -> int:
        """Tokens of a whole word."""
        s = self._bytes(word)
        if not s.isprintable() or " " in s:  # control bytes have stand-ins too
            s = "".join([BYTES[b] for b in word.encode()])
        return 1 if s in self.closing else self._whole(s)

    def _whole(self, s: str) -> int:
        """Token count of a whole word: the recurrence of ``_table``, of which
        only the prefixes on the way to the end are worked out."""
        n, starts, pairs, closing = len(s), self.starts, self.pairs, self.closing
        seen = set()
        way = []  # per settled prefix: its end, its last token, the longest token not tried after it
        at, before = 0, ""
        while True:
            t = closing.get(s[at:])
            if t is not None:
                ok = pairs.get((before, t))
                if self._pair(before, t) if ok is None else ok:
                    return len(way) + 1
            # Beginnings of tokens have no gaps: from a usual length up or down.
            i = at + 4 if at + 4 < n else n - 1
            t = starts.get(s[at:i])
            if t is None:
                while t is None and i > at + 1:
                    i -= 1
                    t = starts.get(s[at:i])
            else:
                while i + 1 < n and (more := starts.get(s[at:i + 1])) is not None:
                    t, i = more, i + 1
            way.append((at, before, t))
            while True:  # the longest token that can follow; else back to the prefix before
                at, before, t = way.pop()
                while t:
                    end = at + len(t)
                    if end not in seen:
                        ok = pairs.get((before, t))
                        if self._pair(before, t) if ok is None else ok:
                            break
                    t = starts.get(t[:-1])
                if t:
                    break
                if not way:
                    raise ValueError(f"no encoding of {s!r}")
            way.append((at, before, starts.get(t[:-1])))
            seen.add(end)
            at, before = end, t

    def word_prefixes(self, word: str) -> list[int]:
        """Tokens of each non-empty prefix of a word, taken as a text."""
        if word[0] == "'" and len(word) > 1 and word[1].isalpha():  # a cut contraction splits anew
            return [sum(map(self.word, self.split(word[:i]))) for i in range(1, len(word) + 1)]
        s = "".join([BYTES[b] for b in word.encode()])
        last, count = self._table(s)
        ends = accumulate(len(c.encode()) for c in word)
        return [self._closed(s, i, last, count) for i in ends]

    # -- texts -----------------------------------------------------------------

    def normalise(self, text: str) -> str:
        if not self.beyond.search(text):
            return text.lower()
        return self.library.normalizer.normalize_str(text)

    def split(self, normal: str) -> list[str]:
        """Words of a normalised text."""
        if not self.beyond.search(normal):
            return self.words.findall(normal)
        return [normal[a:b] for a, b in self._spans(normal)]

    def _spans(self, normal: str) -> Iterable[tuple[int, int]]:
        if not self.beyond.search(normal):
            return (m.span() for m in self.words.finditer(normal))
        # The library splits; a word longer than one code point per byte is
        # reported by its place in the text.
        return [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Normalised stretches between special tokens, and those tokens."""
        if "<|" not in text and not self.special.search(text):
            yield self.normalise(text), False
            return
        at = 0
        for m in self.special.finditer(text):
            yield self.normalise(text[at:m.start()]), False
            yield m[0], True
            at = m.end()
        yield self.normalise(text[at:]), False

    def count(self, text: str) -> int:
        return self.count_and_fit(text)[0]

    def count_and_fit(self, text: str, budget: int | None = None) -> tuple[int, int]:
        """Tokens of a text, and the length of its longest prefix of at most
        ``budget`` tokens (the whole text's without one)."""
        parts, known = list(self.segments(text)), self.cache.__getitem__
        n = sum(1 if special else sum(map(known, self.split(s))) for s, special in parts)
        if budget is None or n <= budget:
            return n, sum(len(s) for s, _ in parts)
        return n, self._fitting(parts, budget)

    def fits(self, text: str, budget: int) -> int:
        """Length of the longest prefix of at most ``budget`` tokens."""
        return self._fitting(self.segments(text), budget)

    def _fitting(self, parts: Iterable[tuple[str, bool]], budget: int) -> int:
        done = at = 0
        for s, special in parts:
            if special:
                if done + 1 > budget:
                    return at
                done, at = done + 1, at + len(s)
                continue
            for a, b in self._spans(s):
                n = self.cache[s[a:b]]
                if done + n > budget:
                    inside = self.word_prefixes(s[a:b])
                    return at + a + max((i for i, c in enumerate(inside, 1) if done + c <= budget),
                                        default=0)
                done += n
            at += len(s)
        return at

    def prefixes(self, text: str) -> Iterator[int]:
        """Tokens of the prefixes of length 1, 2, ... of the normalised text.
        A special token counts once it is whole; before that its characters
        count as ordinary text."""
        done = 0
        for s, special in self.segments(text):
            if special:
                for i in range(1, len(s)):
                    yield done + sum(map(self.word, self.split(self.normalise(s[:i]))))
                done += 1
                yield done
                continue
            at = 0
            for a, b in self._spans(s):
                yield from [done] * (a - at)
                counts = self.word_prefixes(s[a:b])
                yield from (done + c for c in counts)
                done, at = done + counts[-1], b
            yield from [done] * (len(s) - at)


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The worker's counter of a vocabulary file, loaded once per process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def _field(df: DataFrame, name: str) -> T.StructField:
    return T.StructField(name, df.schema[name].dataType)


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 budget: int = 2048) -> DataFrame:
    """Per input row: id, ``n_bytes``, ``n_tokens`` and ``n_fit``, the length
    of the longest prefix (code points of the normalised text) that stays
    within ``budget`` tokens. Narrow: no shuffle; memory is one Arrow batch."""
    ship_package(df.sparkSession)
    schema = T.StructType([_field(df, id_col), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()),
                           T.StructField("n_fit", T.LongType())])

    def run(batches):
        c = counter(path)
        for batch in batches:
            found = [c.count_and_fit(x or "", budget) for x in batch.column(1).to_pylist()]
            tokens, fit = [n for n, _ in found], [n for _, n in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64()),
                 pa.array(fit, pa.int64())], names=[id_col, "n_bytes", "n_tokens", "n_fit"])

    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
    return df.select(F.col(id_col), F.col(text_col), size.alias("__bytes")).mapInArrow(run, schema)


def prefix_table(df: DataFrame, path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """The stored counts: rows (id, ``chunk_no``, ``start``, ``counts``), where
    ``counts[i]`` is the exact token count of the prefix of ``start + i``
    code points. Chunk 0 starts with the empty prefix. Long texts take several
    rows, so no row grows with its text. Ids should be unique: rows with the
    same id cannot be told apart in this table."""
    ship_package(df.sparkSession)
    schema = T.StructType([_field(df, id_col), T.StructField("chunk_no", T.IntegerType()),
                           T.StructField("start", T.LongType()),
                           T.StructField("counts", T.ArrayType(T.IntegerType()))])

    def rows(c, key, text):
        part, no = [0], 0
        for n in c.prefixes(text or ""):
            if len(part) == CHUNK:
                yield key, no, no * CHUNK, part
                part, no = [], no + 1
            part.append(n)
        yield key, no, no * CHUNK, part

    def run(batches):
        c = counter(path)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = list(zip(*rows(c, key, text)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()),
                     pa.array(out[2], pa.int64()), pa.array(out[3], pa.list_(pa.int32()))],
                    names=[id_col, "chunk_no", "start", "counts"])

    return df.select(id_col, text_col).mapInArrow(run, schema)


def longest_prefix(prefixes: DataFrame, budget: int, id_col: str = "doc_id") -> DataFrame:
    """From a prefix table: per id the longest prefix of at most ``budget``
    tokens and its count. No text is read or encoded."""
    within = F.filter(F.transform("counts", lambda c, i: F.struct(
        (F.col("start") + i).alias("length"), c.alias("n"))), lambda x: x["n"] <= budget)
    best = prefixes.select(id_col, F.array_max(within).alias("best"))
    return (best.groupBy(id_col).agg(F.max("best").alias("best"))
                .select(id_col, F.col("best.length").alias("n_fit"), F.col("best.n").alias("n_tokens")))


def tokens_at(prefixes: DataFrame, at: DataFrame, id_col: str = "doc_id",
              position: str = "position") -> DataFrame:
    """Exact token counts of the prefixes that ``at`` (id, position) names; a
    position past the end gives the whole text's count is not assumed: null."""
    want = at.select(F.col(id_col), F.col(position),
                     F.floor(F.col(position) / CHUNK).cast("int").alias("chunk_no"))
    got = want.join(prefixes, [id_col, "chunk_no"], "left")
    return got.select(id_col, position, F.get(
        "counts", (F.col(position) - F.col("start")).cast("int")).alias("n_tokens"))
