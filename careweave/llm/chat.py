"""Chat formatting: one string per conversation, masks from offsets by binary search."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

OPEN, CLOSE = "<turn>", "</turn>\n"
_CONTROL = re.compile(r"\\|<(?=/?turn>)")


def escape(text: str) -> str:
    """No control string is left: a backslash is doubled, and put after the ``<`` of one."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"([\\<])\\", r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its assistant texts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role).replace("\n", "<\\n") + "\n", escape(text)
        out += [head, body, CLOSE]
        at += len(head)
        if role == "assistant":
            spans.append((at, at + len(body)))
        at += len(body) + len(CLOSE)
    return "".join(out), spans


def parse(text: str) -> list[tuple[str, str]]:
    turns = []
    for part in text.split(CLOSE)[:-1]:
        role, _, body = part[len(OPEN):].partition("\n")
        turns.append((unescape(role.replace("<\\n", "\n")), unescape(body)))
    return turns


def masked(offsets: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(token, start, end) where a token and a span meet, in order."""
    starts, ends = (np.array([x[i] for x in offsets], np.int64) for i in (0, 1))
    out = []
    for a, b in spans:
        for i in range(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))):
            if max(a, starts[i]) < min(b, ends[i]):
                out.append((i, max(a, int(starts[i])), min(b, int(ends[i]))))
    return out


def format_conversations(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Per conversation what its formatted text and its loss mask hold, read back from them.

    Turns are ordered by turn, role, text; nulls come first and count as empty; a null conv_id is
    one conversation. Empty texts have no masked characters; equal turns stay; an empty table
    gives no rows; other columns are ignored. One conversation is one row, so it is formatted in
    one task.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        from tokenizers import Tokenizer

        global _TOKENIZER
        if "_TOKENIZER" not in globals():
            _TOKENIZER = Tokenizer.from_str(spec)
        key = rows["conv_id"].iloc[0]
        rows = rows.fillna({"role": "", "text": ""}).sort_values(
            ["turn", "role", "text"], na_position="first")
        text, spans = render(list(zip(rows["role"], rows["text"], strict=True)))
        offsets = _TOKENIZER.encode(text, add_special_tokens=False).offsets
        whole, upto = [], 0
        for _, a, b in masked(offsets, spans):
            whole.append(text[max(a, upto):b])
            upto = max(upto, b)
        loss = unescape("".join(whole))
        turns = parse(text)
        sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        return pd.DataFrame([[key, len(turns), sha, len(loss), hashlib.sha256(
            loss.encode()).hexdigest(), len(text)]], columns=[
            "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rows.select("conv_id", "turn", "role", "text").groupBy("conv_id").applyInPandas(
        one, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
             "loss_sha256 string, formatted_chars long")
