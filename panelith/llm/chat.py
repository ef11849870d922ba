"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole (its turns in order, each as ``<|turn|>role<|text|>text<|end|>``), encoded once with
offsets, and the sorted spans of assistant texts are intersected with the sorted token spans by binary search: the
tokens that touch a span form one run.  Masked characters are those of masked tokens, clipped to the span.

Control strings (the template's and those of other chat formats) inside a role or text get a backslash after their
first character; strings that already look so get one more, so the step can be undone and no text can forge a turn.

Conversations are sorted within their partition and streamed.  The rows of one longer than SEGMENT characters are cut
between turns, so no task holds more of it than a segment and a turn, but its ids are those of the whole: the text is
handed to the tokenizer up to the letters of a turn's last ``<|end``, where the pre-tokenizer always cuts (no piece goes
on from letters to signs), and the ``|>`` left over comes first in the next segment.  A tokenizer of any other kind
encodes each conversation in one row, whatever its length.

Defined cases: null text or role counts as empty; turns with equal numbers follow role, then text; a null turn comes
first; a null conv_id is a conversation of its own; no assistant turn leaves an empty mask; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, ship

CONTROL = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_RAW = re.compile("|".join(f"({re.escape(c[0])})(\\\\*)({re.escape(c[1:])})" for c in CONTROL))
_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)
SEGMENT, LEARNED = 1 << 18, "assistant"
FORMAT_SCHEMA = "conv_id long, segment int, formatted string, spans array<int>, token_ids array<int>, token_start array<int>, token_end array<int>, loss array<boolean>"


def _groups(m: re.Match) -> tuple[str, str, str]:
    return tuple(g for g in m.groups() if g is not None)


def escape(text: str) -> str:
    def more(m: re.Match) -> str:
        a, slashes, rest = _groups(m)
        return f"{a}\\{slashes}{rest}"

    return _RAW.sub(more, text)


def unescape(text: str) -> str:
    def fewer(m: re.Match) -> str:
        a, slashes, rest = _groups(m)
        return f"{a}{slashes[1:]}{rest}"

    return _RAW.sub(fewer, text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns and the spans of the texts to learn, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<|turn|>{escape(role)}<|text|>", escape(text)
        parts += (head, body, "<|end|>")
        at += len(head)
        if role == LEARNED:
            spans.append((at, at + len(body)))
        at += len(body) + len("<|end|>")
    return "".join(parts), spans


def align(spans: list[tuple[int, int]], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each token whether it touches a span; spans and tokens are sorted, so each span is two binary searches."""
    loss = np.zeros(len(start), bool)
    for a, b in spans:
        if b > a:
            loss[np.searchsorted(end, a, "right") : np.searchsorted(start, b, "left")] = True
    return loss


def masked_texts(formatted: str, spans: list[tuple[int, int]], start: np.ndarray, end: np.ndarray, loss: np.ndarray) -> list[str]:
    """For each span the characters that masked tokens cover, each character once."""
    out = []
    for a, b in spans:
        i, j = np.searchsorted(end, a, "right"), np.searchsorted(start, b, "left")
        k = np.flatnonzero(loss[i:j]) + i if b > a else np.zeros(0, int)
        lo, hi = np.clip(start[k], a, b), np.clip(end[k], a, b)
        if len(k):
            lo = np.maximum(lo, np.concatenate([[a], np.maximum.accumulate(hi)[:-1]]))
        out.append("".join(formatted[x:y] for x, y in zip(lo.tolist(), hi.tolist(), strict=True) if y > x))
    return out


_MODELS: dict = {}
LEFT_OVER = len("|>")


def _model(path: str):
    """(tokenizer, whether its pieces never go on from letters to signs), once for each Python worker."""
    if path not in _MODELS:
        import json

        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        with open(path) as f:
            own = json.load(f)
        pre = own.get("pre_tokenizer") or {}
        _MODELS[path] = model, own.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True and pre.get("add_prefix_space") is False
    return _MODELS[path]


def _runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[object, pd.DataFrame]]:
    """(key, rows) for successive runs of equal keys within each batch; a run may go on in the next batch."""
    for pdf in batches:
        if len(pdf):
            k = pdf[key].to_numpy(dtype=object)
            same = [(a == b) or (pd.isna(a) and pd.isna(b)) for a, b in zip(k[1:], k[:-1], strict=True)]
            cuts = [0, *(np.flatnonzero(~np.asarray(same, bool)) + 1), len(pdf)] if len(k) > 1 else [0, 1]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield (None if pd.isna(k[a]) else int(k[a])), pdf.iloc[a:b]


def format_conversations(turns: DataFrame, tokenizer_path: str, segment: int = SEGMENT) -> DataFrame:
    """conv_id, segment, formatted, spans (start, end, ...), token_ids, token_start, token_end, loss."""
    ship(turns.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, cuts = _model(tokenizer_path)

        def made(conv, number, held, more=False):
            text, spans = render(held)
            before = "|>" if number else ""
            e = model.encode(before + (text[:-LEFT_OVER] if more else text), add_special_tokens=False)
            offsets = np.asarray(e.offsets, np.int64).reshape(-1, 2) - len(before)
            loss = align(spans, offsets[:, 0], offsets[:, 1])
            return {"conv_id": conv, "segment": number, "formatted": text, "spans": [x for s in spans for x in s], "token_ids": e.ids, "token_start": offsets[:, 0].tolist(), "token_end": offsets[:, 1].tolist(), "loss": loss.tolist()}

        conv, number, held, chars, out, any_rows = None, 0, [], 0, [], False
        for key, rows in _runs(batches, "conv_id"):
            if any_rows and key != conv:
                out.append(made(conv, number, held))
                number, held, chars = 0, [], 0
            conv, any_rows = key, True
            for role, text in zip(rows["role"], rows["text"], strict=True):
                if cuts and chars > segment:
                    out.append(made(conv, number, held, more=True))
                    number, held, chars = number + 1, [], 0
                held.append((role, text))
                chars += len(text)
            if len(out) >= 64:
                yield _frame(out)
                out = []
        if any_rows:
            out.append(made(conv, number, held))
            yield _frame(out)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInPandas(work, FORMAT_SCHEMA)


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows)
    if "conv_id" in out:
        out["conv_id"] = out["conv_id"].astype("Int64")
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the formatted rows alone."""
    ship(formatted.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, out = None, []

        def end():
            conv, n, turns, chars, loss, size = state
            return {"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": size}

        for key, rows in _runs(batches, "conv_id"):
            if state is None or state[0] != key:
                if state is not None:
                    out.append(end())
                state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for r in rows.itertuples(index=False):
                for m in _TURN.finditer(r.formatted):
                    state[1] += 1
                    state[2].update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
                spans = np.asarray(r.spans, np.int64).reshape(-1, 2)
                for text in masked_texts(r.formatted, spans.tolist(), np.asarray(r.token_start, np.int64), np.asarray(r.token_end, np.int64), np.asarray(r.loss, bool)):
                    plain = unescape(text)
                    state[3] += len(plain)
                    state[4].update(plain.encode())
                state[5] += len(r.formatted)
            if len(out) >= 4096:
                yield _frame(out)
                out = []
        if state is not None:
            out.append(end())
            yield _frame(out)

    rows = formatted.select("conv_id", "segment", "formatted", "spans", "token_start", "token_end", "loss")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "segment").mapInPandas(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Formats, writes and reads back."""
    return read_back(durable(format_conversations(turns, tokenizer_path), "chat"))
