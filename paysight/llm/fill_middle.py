"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as a row of frames: runs of at most ``FRAME`` units (a unit is one code
point), each compressed on its own as a zstandard frame, beside ``ends``, the cumulative
number of units up to the end of each frame. So the frame that holds a unit is found by a
binary search in ``ends``, and no other frame has to be decompressed.

* ``store`` turns texts into frames.
* ``fill_in_middle`` cuts a stored text in prefix, middle and suffix and orders the parts.
  Only the (at most two) frames that hold a cut are decompressed and cut; all other frames
  go into the output as they are, between the frames of the marks.
* ``sha256_of`` and ``restored_sha256`` stream the frames in order, one decompressed frame
  at a time. Restoring finds the marks by a streamed search, then reads the parts by seeking.
* ``text_of`` and ``restored_text`` give the texts themselves.

Why the marks are found again: a text with a mark in it stays plain, and a mark can't arise
across the border of a part and a mark, as marks begin with ``<`` and hold no other one.

Defined results: a null text counts as the empty one (plain, n 0); a null id is hashed like
the empty string; repeated rows are transformed each, alike where id and text agree; an empty
table gives an empty result; input columns with the names of the results are replaced, all
others are kept. Texts of any length are stored whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.llm.common import bound_batches, table, text_or_empty, unused

#: Units of a frame and level of compression.
FRAME, LEVEL = 16_384, 1
FRAMES = "struct<ends: array<bigint>, data: array<binary>>"
#: Fixed values of the contract: the marks, the percentage that is transformed, and of that the share of spm.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM_RATE = 90, 20


@lru_cache(maxsize=1)
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()


class Frames:
    """The frames of one text: ``ends`` (cumulative units) and the compressed ``data``."""

    def __init__(self, ends: Sequence[int] = (), data: Sequence[bytes] = ()):
        self.ends, self.data = list(ends), list(data)

    @classmethod
    def of(cls, text: str, size: int = FRAME) -> Frames:
        out = cls()
        for i in range(0, len(text), size):
            out.add(text[i:i + size])
        return out

    def __len__(self) -> int:
        return int(self.ends[-1]) if self.ends else 0

    def add(self, text: str) -> None:
        if text:
            self._append(len(text), _codec()[0].compress(text.encode("utf-8", "surrogatepass")))

    def _append(self, units: int, frame: bytes) -> None:
        self.ends.append(len(self) + units)
        self.data.append(frame)

    def frame(self, i: int) -> str:
        return _codec()[1].decompress(bytes(self.data[i])).decode("utf-8", "surrogatepass")

    def _runs(self, lo: int, hi: int) -> Iterator[tuple[int, int, int, bool]]:
        """Frames that hold units of [lo, hi): number, first and last unit inside, whether whole."""
        i = bisect_right(self.ends, lo)
        while lo < hi:
            start, end = (self.ends[i - 1] if i else 0), self.ends[i]
            yield i, int(lo - start), int(min(hi, end) - start), lo == start and hi >= end
            lo, i = end, i + 1

    def extend(self, other: Frames, lo: int, hi: int) -> None:
        """Append units [lo, hi) of another text: cut frames are decompressed, whole ones taken over."""
        for i, a, b, whole in other._runs(lo, hi):
            if whole:
                self._append(b, bytes(other.data[i]))
            else:
                self.add(other.frame(i)[a:b])

    def read(self, lo: int, hi: int) -> Iterator[str]:
        """Units [lo, hi), one frame at a time."""
        for i, a, b, _ in self._runs(lo, hi):
            yield self.frame(i)[a:b]

    def find(self, mark: str, start: int = 0) -> int:
        """First unit from ``start`` on where the mark stands, by a streamed search; -1 if nowhere."""
        at, carry = start, ""
        for part in self.read(start, len(self)):
            seen = carry + part
            if (k := seen.find(mark)) >= 0:
                return at - len(carry) + k
            at += len(part)
            carry = seen[-(len(mark) - 1):]
        return -1


def arranged(text: Frames, form: str, prefix: int, middle: int) -> Frames:
    """The output of one stored text whose prefix and middle have these many units."""
    n, cut = len(text), prefix + middle
    if form == "plain":
        return text
    out = Frames()
    first, second = ((PREFIX, 0, prefix), (SUFFIX, cut, n)) if form == "psm" else ((SUFFIX, cut, n), (PREFIX, 0, prefix))
    for mark, lo, hi in (first, second, (MIDDLE, prefix, cut)):
        out.add(mark)
        out.extend(text, lo, hi)
    return out


def restored(output: Frames, form: str) -> Iterator[str]:
    """The text, rebuilt part by part from the output and its form alone."""
    n = len(output)
    if form == "plain":
        yield from output.read(0, n)
        return
    w = len(PREFIX)
    second = output.find(SUFFIX if form == "psm" else PREFIX, w)
    third = output.find(MIDDLE, second + w)
    prefix, suffix = (w, second), (second + w, third)
    if form == "spm":
        prefix, suffix = suffix, prefix
    for lo, hi in (prefix, (third + w, n), suffix):
        yield from output.read(lo, hi)


def _sha256(parts: Iterator[str]) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p.encode("utf-8", "surrogatepass"))
    return h.hexdigest()


def _rows(frames: pd.DataFrame) -> Iterator[Frames]:
    return (Frames(e, d) for e, d in zip(frames["ends"], frames["data"], strict=True))


def _packed(rows: list[Frames]) -> pd.DataFrame:
    return pd.DataFrame({"ends": pd.Series([r.ends for r in rows], dtype=object), "data": pd.Series([r.data for r in rows], dtype=object)})


def store(docs: DataFrame, text: str = "text", out: str = "frames", size: int = FRAME) -> DataFrame:
    """Add the frames of a text column under the name ``out``."""
    bound_batches(docs.sparkSession)

    @F.pandas_udf(FRAMES)
    def framed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield _packed([Frames.of(t, size) for t in s])
    return docs.withColumn(out, framed(text_or_empty(text)))


def units(frames: str | Column) -> Column:
    """Number of units of stored texts."""
    c = F.col(frames) if isinstance(frames, str) else frames
    return F.coalesce(F.try_element_at(c["ends"], F.lit(-1)), F.lit(0).cast("long"))


def sha256_of(frames: str | Column) -> Column:
    """sha256 (lowercase hex) of the UTF-8 bytes of stored texts."""
    @F.pandas_udf("string")
    def digest(frames: pd.DataFrame) -> pd.Series:
        return pd.Series([_sha256(f.read(0, len(f))) for f in _rows(frames)], dtype=object)
    return digest(frames)


def restored_sha256(output: str | Column, form: str | Column) -> Column:
    """sha256 of the texts rebuilt from outputs and forms."""
    @F.pandas_udf("string")
    def digest(output: pd.DataFrame, form: pd.Series) -> pd.Series:
        return pd.Series([_sha256(restored(f, k)) for f, k in zip(_rows(output), form, strict=True)], dtype=object)
    return digest(output, form)


def text_of(frames: str | Column) -> Column:
    @F.pandas_udf("string")
    def whole(frames: pd.DataFrame) -> pd.Series:
        return pd.Series(["".join(f.read(0, len(f))) for f in _rows(frames)], dtype=object)
    return whole(frames)


def restored_text(output: str | Column, form: str | Column) -> Column:
    @F.pandas_udf("string")
    def whole(output: pd.DataFrame, form: pd.Series) -> pd.Series:
        return pd.Series(["".join(restored(f, k)) for f, k in zip(_rows(output), form, strict=True)], dtype=object)
    return whole(output, form)


def draws(id_col: str, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers of a row: the first 8-digit groups of a sha256 of seed and id."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), ident).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 1, rate: int = RATE,
                   spm_rate: int = SPM_RATE, frames: str | None = None) -> DataFrame:
    """Add ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` (frames) to each row.

    ``frames``: a column that holds the texts as ``store`` gives them, where a stored table is
    kept; without one the texts are stored on the way, row by row, and nothing is written."""
    body = text_or_empty(text)
    marked, given = unused(docs, "_marked"), frames is not None
    frames = frames or unused(docs, "_frames")
    kept = docs.withColumn(marked, body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE))
    kept = kept if given else store(kept, text, frames)
    h1, h2, h3, h4 = draws(id_col, seed)
    kept = kept.withColumn("n", units(frames))
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    form = F.when((F.col("n") == 0) | F.col(marked) | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    kept = kept.withColumn("form", form)
    cut = F.col("form") != "plain"
    kept = kept.withColumns({"prefix_chars": F.when(cut, F.least(a, b)), "middle_chars": F.when(cut, F.greatest(a, b) - F.least(a, b))})

    @F.pandas_udf(FRAMES)
    def arrange(frames: pd.DataFrame, form: pd.Series, prefix: pd.Series, middle: pd.Series) -> pd.DataFrame:
        return _packed([arranged(f, k, int(p), int(m)) for f, k, p, m in zip(_rows(frames), form, prefix, middle, strict=True)])
    zero = F.lit(0).cast("long")
    return kept.withColumn("output", arrange(frames, "form", F.coalesce("prefix_chars", zero), F.coalesce("middle_chars", zero))).drop(marked, *([] if given else [frames]))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha256_of("output").alias("output_sha256"),
                       restored_sha256("output", "form").alias("restored_sha256"))
