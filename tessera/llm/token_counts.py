"""Operator 1: token counts by the whole-token shortcut.

A sentencepiece BPE model never merges across a word start when no piece of
its vocabulary holds the space mark behind another character.  A text is then
a sequence of pre-tokens (a run of space marks and the characters up to the
next one) that encode independently.  ``prove_whole`` establishes, once per
vocabulary and by the library itself, which pieces come back as exactly one
token; pre-tokens found there count 1 without any merging, and only the rest
is merged (by the library, each distinct one once per cache life).

Cases: null or empty text has 0 tokens; a text without any space is one
pre-token, of whatever length; equal texts give equal counts; an empty table
gives an empty result; further columns are ignored.  If a vocabulary does hold
a piece across words, texts are encoded whole.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: pre-tokens whose counts a Python worker remembers before it starts afresh
CACHE_ENTRIES = 300_000
#: a pre-token longer than this isn't remembered
CACHE_LEN = 64

_PRETOKEN = re.compile(r" +[^ ]*")
_STATE: dict[str, "Counter"] = {}


def prove_whole(sp) -> tuple[set[str], bool]:
    """(pre-tokens that the library encodes as one token, whether pre-tokens
    are independent).  A pre-token is given without its first space."""
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    independent = not any(MARK in p.lstrip(MARK) for p in pieces)
    heads = [p[1:].replace(MARK, " ") for p in pieces if p.startswith(MARK)]
    whole = {w for w, ids in zip(heads, sp.encode(heads, num_threads=1)) if w and len(ids) == 1}
    return whole, independent


class Counter:
    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.whole, self.independent = prove_whole(self.sp)
        # splitting is sound only if the normaliser keeps every space and puts one before the text
        probe = [self.sp.encode(x, out_type=str) for x in ("a", "  a  b ")]
        self.independent &= "".join(probe[0]) == MARK + "a" and "".join(probe[1]) == f"{MARK * 3}a{MARK * 2}b{MARK}"
        self.start()

    def start(self) -> None:
        self.known = dict.fromkeys(self.whole, 1)

    def count(self, texts: list[str]) -> list[int]:
        if not self.independent:
            return [len(x) for x in self.sp.encode(texts, num_threads=1)]
        parts = []
        for t in texts:
            if not t:
                parts.append([])
                continue
            if MARK in t:
                t = t.replace(MARK, " ")
            if "  " in t or t[0] == " " or t[-1] == " ":
                parts.append([p[1:] for p in _PRETOKEN.findall(" " + t)])
            else:
                parts.append(t.split(" "))
        known = self.known
        rest = [w for w in set().union(*parts) if w not in known]
        long_ = {}
        if rest:
            for w, ids in zip(rest, self.sp.encode(rest, num_threads=1)):
                # a pre-token of one lone space is empty here; the library gives nothing for an empty text
                n = len(ids) if w else 1
                (known if len(w) <= CACHE_LEN else long_)[w] = n
        if long_:
            out = [sum(known[w] if w in known else long_[w] for w in p) for p in parts]
        else:
            get = known.__getitem__
            out = [sum(map(get, p)) for p in parts]
        if len(known) > CACHE_ENTRIES + len(self.whole):
            self.start()
        return out


def counter(path: str) -> Counter:
    """The worker's counter for a model file, built once per process."""
    if path not in _STATE:
        _STATE[path] = Counter(path)
    return _STATE[path]


def token_counts(df: DataFrame, text: str, model: str) -> Column:
    """Column expression: number of tokens of ``text`` under ``model``, without
    begin, end or added special tokens."""
    @F.pandas_udf("long")
    def n_tokens(s):
        import pandas as pd
        c, out = counter(model), np.empty(len(s), np.int64)
        vals = s.fillna("").tolist()
        for a in range(0, len(vals), 256):
            out[a:a + 256] = c.count(vals[a:a + 256])
        return pd.Series(out)
    return n_tokens(F.col(text))


def count_tokens(df: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of ``df`` (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (df.select("doc_id", text.alias("text"))
            .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                    token_counts(df, "text", model).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
