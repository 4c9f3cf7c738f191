"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import os
import re
import string
import unicodedata
from array import array

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.session import ensure_checkpoint_dir, write_table

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Unicode White_Space, what ``\s`` means to the pre-tokenizers.
_SPACE = " \t\n\x0b\x0c\r\x85\xa0  -     　"
_LED_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_BARE_CHUNK = re.compile(f"[^{_SPACE}]+")
# Contractions, special tokens, signs that only Python takes for space, and those that lower case or composition may turn into others.
_ODD = re.compile("['\x1c-\x1f\u0130\u0250-\U0010ffff]|<\\|")
_PUNCTUATION = re.compile(r"(?:[^\w\s]|_)+")
_NOT_SPACE = "\x1c\x1d\x1e\x1f"  # str.split() parts at these, the pre-tokenizers don't
# The same for Arrow, whose own classes hold ASCII alone: signs below U+0250 are named one by one.
_ODD_RE2 = "['\\x1c-\\x1f\\x{130}\\x{250}-\\x{10ffff}]|<\\|"
_PUNCTUATION_RE2 = "([" + "".join(f"\\x{{{c:x}}}" for c in range(0x250) if _PUNCTUATION.fullmatch(chr(c))) + "]+)"
_NOT_SPACE_RE2 = "[\\x1c-\\x1f]"
# Pre-tokens of the byte-level tokenizer for Arrow, which can't look ahead: runs of white space that do are kept with what follows.
_OTHER_RE2 = f"[^{_SPACE}\\pL\\pN]+"
_LED_PIECE_RE2 = (f"'(?:s|t|re|ve|m|ll|d)| ?\\pL+| ?\\pN+| ?{_OTHER_RE2}"
                  f"|[{_SPACE}][{_SPACE}]+(?:\\pL+|\\pN+|{_OTHER_RE2})|[{_SPACE}]+")
_LED_ODD_RE2 = f"[\\x1c-\\x1f\\x{{250}}-\\x{{10ffff}}]|<\\||[{_SPACE}][{_SPACE}]'"
_CUT = "\x1f"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def bare_chunks(text: str) -> list[str]:
    """Runs without white space."""
    if any(c in text for c in _NOT_SPACE):
        return _BARE_CHUNK.findall(text)
    return text.split()


def led_chunks(text: str) -> list[str]:
    """Runs without white space, each with the white space before it; white
    space at the end stands alone.  Together they are the whole text."""
    return _LED_CHUNK.findall(text)


_TAIL = "".join(c for c in string.punctuation if c != "'")
_HELD: dict[tuple, object] = {}


def one_store(key: tuple, make):
    """What a worker process keeps from task to task: the last thing asked for
    alone, so that the stores of several operators don't add up."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def letters_core(chunk: str) -> str:
    """The run of letters (a blank may lead) that can be encoded apart from the
    punctuation after it, else the whole chunk."""
    core = chunk.rstrip(_TAIL)
    if not (core[1:] if core[:1] == " " else core).isalpha():
        return chunk
    if not core.isascii() and not unicodedata.normalize("NFC", core.lower())[-1].isalpha():
        return chunk  # a mark that comes off the last letter joins the punctuation
    return core


def _byte_signs() -> str:
    """The sign that stands for each byte in byte-level tokenizers: printable
    ones for themselves, the others in order from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


_SIGNS = _byte_signs()


class _Store(dict):
    """A dict that makes what is missing.  At ``limit`` entries it starts
    anew, but takes from the entries before what is asked for again, so that
    frequent keys stay; keys over ``longest`` signs aren't kept."""

    def __init__(self, make, limit: int, longest: int):
        self.make, self.limit, self.longest, self.before = make, limit, longest, {}

    def __missing__(self, key: str) -> bytes:
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


class ChunkEncoder:
    """Token ids of whole texts, through the tokenizers library.

    White space always ends a pre-token of the two public tokenizers used
    here, so a text's ids are those of its chunks in a row; the same holds
    between a run of letters and the ASCII punctuation after it (apostrophes
    aside, which start contractions).  Pieces and their parts are encoded by the
    library once and kept as bytes (little-endian uint32), in stores of some
    60 MB at most for 200,000 entries that leave out long chunks.
    """

    def __init__(self, path: str, led: bool, limit: int = 200_000, longest: int = 60):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.split = led_chunks if led else bare_chunks
        self.lowers = not led
        self.model = self.tokenizer.model.tokenize
        self.parts = _Store(self._part, limit // 4 if led else limit, longest)  # pre-tokens are looked up as pieces
        self.kept = _Store(self._chunk, limit, longest)

    @staticmethod
    def of(path: str, led: bool) -> "ChunkEncoder":
        return one_store(("encoder", path, led), lambda: ChunkEncoder(path, led, 320_000 if led else 400_000))

    def _part(self, part: str) -> bytes:
        # Letters below U+0250 (but for the dotted capital I) stay one pre-token and
        # change in lower case and byte signs alone: the library's model takes them so.
        led = part[:1] == " "
        if (part[1:] if led else part).isalpha():
            plain = part.isascii()
            if plain or not _ODD.search(part):
                if self.lowers:
                    part = part.lower()
                if not plain:
                    part = part.encode("utf-8").decode("latin-1").translate(_SIGNS)
                elif led:
                    part = _SIGNS[32] + part[1:]
                return array("I", self._word(part)).tobytes()
        return array("I", self._other(part)).tobytes()

    def _word(self, word: str) -> list[int]:
        """Ids of one pre-token in byte signs."""
        return [t.id for t in self.model(word)]

    def _other(self, part: str) -> list[int]:
        return self.tokenizer.encode(part, add_special_tokens=False).ids

    def _chunk(self, chunk: str) -> bytes:
        if self.lowers and chunk.isalpha():
            if chunk.islower():
                return self._part(chunk)
            if chunk.isascii():
                return self.parts[chunk.lower()]
        core = chunk if chunk.isalpha() else letters_core(chunk)
        if len(core) == len(chunk) and not self.lowers:
            return self._part(chunk)
        own = core.lower() if self.lowers and core.isascii() and "<" not in core else core
        return self.parts[own] + self.parts[chunk[len(core):]] if len(core) < len(chunk) else self.parts[own]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        collects = gc.isenabled()
        gc.disable()  # only strings and bytes are made, in great number
        try:
            get, split = self.kept.__getitem__, self.split
            return [b"".join(map(get, split(t))) for t in texts]
        finally:
            if collects:
                gc.enable()

    def encode_column(self, texts, most: int = 4_000_000):
        """The ids of each text of an Arrow column, in order."""
        for ids in self.encode_slices(texts, most):
            yield from ids.to_pylist()

    def encode_slices(self, texts, most: int = 4_000_000):
        """Arrow arrays of the ids (large binary) of an Arrow column's texts,
        in order; about ``most`` bytes (or one text) at a time.  Arrow cuts the
        texts into pieces, and each distinct piece is looked up once.  For a
        tokenizer that lower-cases, parts at white space and parts runs of
        letters from runs of punctuation, pieces are those runs in lower case,
        if the text holds no apostrophe (contractions), special token or
        unusual sign; for the byte-level one they are the pre-tokens, a longer
        run of white space with what follows it.  Else they are the chunks."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        texts = texts.cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        i = 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(ends, most + (ends[i - 1] if i else 0), side="right")))
            yield self._column_ids(texts.slice(i, j - i))
            i = j

    def _column_ids(self, texts):
        import pyarrow as pa
        import pyarrow.compute as pc
        pieces, odd = self._bare_pieces(texts) if self.lowers else self._led_pieces(texts)
        known = pieces.values.dictionary_encode()
        words = known.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array(list(map(self.kept.__getitem__, words)), type=pa.large_binary())
        out = pc.binary_join(pa.LargeListArray.from_arrays(pieces.offsets.cast(pa.int64()), ids.take(known.indices)),
                             pa.scalar(b"", type=pa.large_binary()))
        if odd.true_count:
            cut = pc.match_substring_regex(texts, _NOT_SPACE_RE2)
            if cut.true_count:  # Arrow parts at these signs
                own = self.encode_many(texts.filter(cut).to_pylist())
                out = pc.replace_with_mask(out, cut, pa.array(own, type=pa.large_binary()))
        return out

    @staticmethod
    def _bare_pieces(texts):
        import pyarrow.compute as pc
        odd = pc.match_substring_regex(texts, _ODD_RE2)
        parted = pc.replace_substring_regex(pc.utf8_lower(texts), _PUNCTUATION_RE2, r" \1 ")
        return pc.utf8_split_whitespace(pc.if_else(odd, texts, parted)), odd

    @staticmethod
    def _led_pieces(texts):
        import pyarrow.compute as pc
        odd = pc.match_substring_regex(texts, _LED_ODD_RE2)
        parted = pc.replace_substring_regex(pc.if_else(odd, "", texts), _LED_PIECE_RE2, "\\0" + _CUT)
        if odd.true_count:
            parted = pc.replace_with_mask(parted, odd, pc.replace_substring_regex(texts.filter(odd), _LED_CHUNK.pattern, "\\0" + _CUT))
        return pc.split_pattern(parted, _CUT), odd


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string): the id may be null, a null text is empty.
    Whatever else the table holds is left behind, so no name can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_id_order(rows: DataFrame, partitions: int, *, by: Column | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ascending doc_id (null first),
    equal ids by a hash of the text and then the text, so that one id held by
    very many rows is still dealt to several partitions."""
    tie = F.xxhash64("text")
    return (rows.repartitionByRange(partitions, F.col("doc_id"), tie)
            .sortWithinPartitions(F.col("doc_id"), tie, F.col("text")))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    import uuid
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def small_side(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """A written table with the broadcast hint if it has at most ``max_rows``
    rows (counted), else as it is: the join then shuffles."""
    return F.broadcast(df) if df.count() <= max_rows else df


def split_hot(rows: DataFrame, keys: list[str], own: str, hot: int) -> DataFrame:
    """Rows with columns ``low`` and ``high``: groups of ``keys`` for comparing
    all members of a key.  A key of more than ``hot`` rows is cut into parts by
    a hash of ``own``, and every pair of parts (low, high) is a group, so that
    any two rows of a key still meet."""
    large = write_table(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot)
                        .select(*keys, F.ceil(F.col("n") / hot).cast("int").alias("parts")), "hot-keys")
    return (rows.join(small_side(large), keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("mine", F.pmod(F.xxhash64(own), F.col("parts")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))
            .drop("parts", "mine", "other"))
