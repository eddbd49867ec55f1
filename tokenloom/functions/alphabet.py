"""The byte alphabet: which token id and which printable stand-in each byte has."""

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Special literals and their ids (pad, end of text), and the byte ranges that print as themselves.
PAD = "<|pad|>"
EOS = "<|endoftext|>"
PAD_ID = 0
EOS_ID = 1
PRINTABLE = ((33, 126), (161, 172), (174, 255))
BYTE_VOCAB_SIZE = 258

# Bytes that never occur in UTF-8 text stand for the special literals while text travels as one byte per token.
PAD_CODE = 0xFE
EOS_CODE = 0xFF


def stand_ins() -> list[str]:
    """The printable character of each byte: itself where it prints, else the next one from U+0100."""
    prints = [any(lo <= b <= hi for lo, hi in PRINTABLE) for b in range(256)]
    spare = iter(range(256, 512))
    return [chr(b) if ok else chr(next(spare)) for b, ok in enumerate(prints)]


def byte_ids() -> np.ndarray:
    """Token id of each byte: 2 plus the rank of its stand-in by code point."""
    chars = np.array([ord(c) for c in stand_ins()])
    return (np.argsort(np.argsort(chars)) + 2).astype(np.int32)


def code_ids() -> np.ndarray:
    """Token id of each byte code; the two spare codes are the special literals."""
    table = byte_ids()
    table[PAD_CODE] = PAD_ID
    table[EOS_CODE] = EOS_ID
    return table


def special_tokens(spark: SparkSession, pad_is_eos: bool = False) -> DataFrame:
    """Role, literal and id. ``pad_is_eos`` is the ready-made-vocabulary setting."""
    pad = (EOS, EOS_ID) if pad_is_eos else (PAD, PAD_ID)
    return spark.createDataFrame(
        [("pad", *pad), ("eos", EOS, EOS_ID), ("bos", EOS, EOS_ID)], "role string, literal string, token_id int"
    )


def byte_vocab(spark: SparkSession) -> DataFrame:
    """The 258-row vocabulary (token_id, token)."""
    rows = [(PAD_ID, PAD), (EOS_ID, EOS)] + list(zip(byte_ids().tolist(), stand_ins()))
    return spark.createDataFrame(rows, "token_id int, token string").orderBy("token_id")


def readable(column):
    """Bytes of a binary column written with their stand-ins."""
    latin = F.decode(column, "ISO-8859-1")
    return F.translate(latin, "".join(chr(b) for b in range(256)), "".join(stand_ins()))
