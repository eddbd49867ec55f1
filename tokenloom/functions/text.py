"""Row-local column functions on text: newline rules, names, hashing, words and byte codes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions import alphabet, kernels

# Fixed value: the public pre-tokenisation pattern for byte-level BPE.
_WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d", r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+", r"\s+(?!\S)|\s+")
WORD_PATTERN = "(?U)" + "|".join(_WORDS)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_div(value: Column, by: Column | int) -> Column:
    """Integer division, exact for any LONG."""
    return F.call_function("div", value, F.lit(by))


def unix_newlines(text: Column | str) -> Column:
    """C4: every line end becomes one newline. Most texts have no carriage return and skip the regular expression."""
    text = as_column(text)
    return F.when(F.contains(text, F.lit("\r")), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def file_lines(text: Column | str) -> Column:
    """The lines a line reader would give for a file of this text (a final newline ends the last line)."""
    text = as_column(text)
    ended = F.when(F.endswith(text, F.lit("\n")), F.left(text, F.char_length(text) - 1)).otherwise(text)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(ended, "\n"))


def path_stem(path: Column | str) -> Column:
    return F.regexp_extract(as_column(path), r"([^/]+?)(\.[^./]*)?$", 1)


def run_name(path: Column | str, tag: Column | None = None, prefix: str = "") -> Column:
    """An explicit, non-empty tag, else the file stem."""
    stem = path_stem(path)
    name = stem if tag is None else F.coalesce(F.nullif(tag, F.lit("")), stem)
    return F.concat(F.lit(prefix), name)


def shuffle_key(seed: int, *keys: Column | str) -> Column:
    """A reproducible random-looking key for a row; the same in any SQL engine that has md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[as_column(k).cast("string") for k in keys]))


def hash_number(key: Column | str, digits: int = 8) -> Column:
    """The leading hex digits of a shuffle key as a number."""
    return F.conv(F.substring(as_column(key), 1, digits), 16, 10).cast("long")


def words(text: Column | str) -> Column:
    """The pre-tokenised words of a text, each with its leading space."""
    return F.regexp_extract_all(as_column(text), F.lit(WORD_PATTERN), F.lit(0))


def byte_codes(text: Column | str, eos: bool = True) -> Column:
    """E1 and E3 in compact form: BINARY with one byte per token.

    UTF-8 never holds the bytes FE and FF, so they stand for the pad and end-of-text literals. Token tables stay as
    small as the text through every shuffle; ``code_ids`` turns them into ids at the end.
    """
    valid = F.make_valid_utf8(as_column(text))
    latin = F.decode(valid.cast("binary"), "ISO-8859-1")
    for literal, code in ((alphabet.EOS, alphabet.EOS_CODE), (alphabet.PAD, alphabet.PAD_CODE)):
        latin = F.replace(latin, F.lit(literal), F.lit(chr(code)))
    plain = valid.cast("binary")
    codes = F.when(F.contains(valid, F.lit("<|")), F.encode(latin, "ISO-8859-1")).otherwise(plain)
    return F.concat(codes, F.lit(bytes([alphabet.EOS_CODE]))) if eos else codes


def packed_ids(ids: Column | str) -> Column:
    """ARRAY<INT> -> BINARY with four bytes per token, in which token tables are cut, moved and joined as byte codes are."""
    return F.arrow_udf(kernels.list_packer, "binary")(as_column(ids))


def unpacked_ids(packed: Column | str) -> Column:
    """BINARY with four bytes per token -> ARRAY<INT>."""
    return F.arrow_udf(kernels.list_unpacker, "array<int>")(as_column(packed))


def code_ids(codes: Column | str) -> Column:
    """Byte codes -> ARRAY<INT> of token ids."""
    return F.arrow_udf(kernels.code_lookup(alphabet.code_ids()), "array<int>")(as_column(codes))
