"""Cutting texts above a token limit into overlapping pieces at natural boundaries.

Boundaries are token positions. Each boundary's successor is the farthest legal boundary: the piece
from ``overlap`` tokens before the boundary up to there has at most ``limit`` tokens. The successor
tables of a whole batch of documents are squared (pointer doubling), which yields every greedy cut
of every document in a logarithmic number of array operations. A document lives in one row, so the
tables never leave the batch and nothing is shuffled.

Boundary classes, best first: ends of lines and sentences ``overlap`` tokens after the start of a
pre-token; other ends of lines and sentences; such ends of words; such ends of pre-tokens; any token.
A worse class is only opened where the better ones lie farther apart than a piece can reach. From a
boundary whose overlap starts a pre-token, the next piece's text tokenizes to just its tokens, and
neighbours share exactly ``overlap`` of them. Where the overlap starts inside a pre-token, the rest
of that pre-token may take more tokens on its own; the piece is kept short by as many.

Defined results
- NULL or empty text: one empty piece of 0 tokens. Text within the limit: one piece, the text itself.
- a text of at most ``limit`` bytes cannot exceed the limit (a token has a byte or more); it is not tokenized
  and its token count is given as NULL.
- a text without any boundary (one endless word) is cut between tokens, its text between characters.
- repeated rows give repeated pieces. Further columns are not used.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from fieldspark.llm import tokens as tk
from fieldspark.llm.tokens import COUNT, Counter, counter, default_path

LIMIT, OVERLAP = 1200, 100
BATCH_CHARS = 4_000_000


def _gaps(have: np.ndarray, more: np.ndarray, reach: int) -> np.ndarray:
    """``have`` with those of ``more`` that lie between neighbours farther apart than ``reach``."""
    i = np.searchsorted(have, more)
    inside = (i > 0) & (i < len(have))
    j = np.clip(i, 1, len(have) - 1)
    wide = have[j] - have[j - 1] > reach
    return np.union1d(have, more[inside & wide])


def boundaries(pre: list[str], measures: np.ndarray, c: Counter, limit: int, overlap: int) -> tuple[list[np.ndarray], np.ndarray, dict[int, int]]:
    """Token positions by class (each class holds the better ones too), the pre-tokens' ends, and how
    many tokens the piece after a boundary may take in addition, where that is not 0."""
    counts = measures & COUNT
    ends = np.cumsum(counts)
    total = int(ends[-1])
    starts = ends - counts
    here, nxt = measures[:-1], measures[1:]
    blank, line = nxt & tk.BLANK_START != 0, nxt & tk.LINE != 0
    stop, solid = here & tk.STOP != 0, here & tk.BLANK == 0
    at = ends[:-1]
    is_start = np.zeros(total + 1, dtype=bool)
    is_start[starts] = True
    aligned = (at >= overlap) & is_start[np.maximum(at - overlap, 0)]
    natural = solid & (line | (blank & stop)) & (at > overlap)
    reach = limit - overlap
    best = np.unique(np.concatenate([[0], at[natural & aligned], [total]]))
    loose = _gaps(best, at[natural & ~aligned], reach)
    words = _gaps(loose, at[aligned & solid & blank], reach)
    pres = _gaps(words, at[aligned], reach)
    tokens = pres
    wide = np.flatnonzero(np.diff(pres) > reach)
    if len(wide):
        tokens = np.union1d(pres, np.concatenate([np.arange(pres[i], pres[i + 1]) for i in wide]))
    extra = {}
    for b in np.setdiff1d(loose, best).tolist():
        i = int(np.searchsorted(ends, b - overlap, "right"))
        into = b - overlap - int(starts[i])
        more = c.rest_tokens(pre[i], into) - int(counts[i] - into)
        if more > 0:
            extra[b] = more
    return [best, loose, words, pres, tokens], ends, extra


def successors(classes: list[np.ndarray], starts: np.ndarray, limit: int, overlap: int, extra: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All boundaries and the index of each one's farthest legal successor (the last of a text: itself).

    ``starts``: the boundaries at which a text begins; a first piece has no overlap before it.
    """
    every = classes[-1]
    reach = every - overlap + limit
    reach[np.searchsorted(every, starts)] += overlap
    short = reach.copy()
    if extra:
        short[np.searchsorted(every, list(extra))] -= np.array(list(extra.values()))
    nxt = np.full(len(every), -1, dtype=np.int64)
    for far_as in (short, reach) if extra else (reach,):
        for c in classes:
            far = c[np.maximum(np.searchsorted(c, far_as, "right") - 1, 0)]
            take = (nxt < 0) & (far > every) & (far <= far_as)
            nxt[take] = np.searchsorted(every, far[take])
    last = nxt < 0
    nxt[last] = np.flatnonzero(last)
    return every, nxt


def all_cuts(nxt: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mask of every boundary on the greedy paths from ``first``, by squaring the successor table."""
    on = np.zeros(len(nxt), dtype=bool)
    on[first] = True
    jump = nxt
    while True:
        on[jump[on]] = True
        again = jump[jump]
        if np.array_equal(again, jump):
            return on
        jump = again


def _char_at(pos: int, pre: list[str], ends: np.ndarray, chars: np.ndarray, c: Counter) -> int:
    """Character offset of a token position; inside a character it is that character's start."""
    i = int(np.searchsorted(ends, pos, "left"))
    if ends[i] == pos:
        return int(chars[i])
    into = pos - (int(ends[i - 1]) if i else 0)
    size = int(c.token_bytes(pre[i])[:into].sum())
    done = len(pre[i].encode("utf-8")[:size].decode("utf-8", "ignore"))
    return (int(chars[i - 1]) if i else 0) + done


def split_batch(ids: list, texts: list[str], c: Counter, limit: int, overlap: int, with_text: bool) -> list[tuple]:
    """Pieces of a batch of texts above the limit in bytes."""
    docs, classes, base, bases = [], [[], [], [], [], []], 0, []
    rows, more = [], {}
    for ident, text in zip(ids, texts, strict=True):
        pre = c.pre_tokens(text)
        measures = c.measures(pre)
        total = int((measures & COUNT).sum())
        if total <= limit:
            rows.append((ident, 0, 1, 0, total, total, 0, len(text), text if with_text else None))
            continue
        levels, ends, extra = boundaries(pre, measures, c, limit, overlap)
        more.update((b + base, n) for b, n in extra.items())
        for k, positions in zip(classes, levels, strict=True):
            k.append(positions + base)
        docs.append((ident, text, pre, ends, base, total))
        bases.append(base)
        base += total + limit + overlap + 1  # no successor reaches into the next text
    if not docs:
        return rows
    every, nxt = successors([np.concatenate(k) for k in classes], np.array(bases), limit, overlap, more)
    cuts = every[all_cuts(nxt, np.searchsorted(every, bases))]
    for ident, text, pre, ends, base, total in docs:
        own = cuts[np.searchsorted(cuts, base) : np.searchsorted(cuts, base + total, "right")] - base
        begin = np.maximum(own[:-1] - overlap, 0)
        begin[0] = 0
        chars = np.cumsum([len(p) for p in pre]) if with_text else None
        for i, (s, e) in enumerate(zip(begin.tolist(), own[1:].tolist(), strict=True)):
            a = b = t = None
            if with_text:
                a = _char_at(s, pre, ends, chars, c) if s else 0
                b = _char_at(e, pre, ends, chars, c)
                t = text[a:b]
            rows.append((ident, i, len(own) - 1, s, e, e - s, a, b, t))
    return rows


_COLS = ["doc_id", "piece_no", "n_pieces", "start_token", "end_token", "n_tokens", "start_char", "end_char", "text"]
_SCHEMA = "doc_id bigint, piece_no int, n_pieces int, start_token bigint, end_token bigint, n_tokens bigint, start_char bigint, end_char bigint, text string"


def split_documents(docs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, path: str | None = None, with_text: bool = True, sized: bool = True) -> DataFrame:
    """One row per piece; docs: doc_id, text. Offsets are in tokens and characters of the document.

    Without ``sized`` texts that cannot be above the limit (by their bytes) are not counted: their sizes are NULL.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    where = path or default_path()

    def run(batches):
        c = counter(where)
        for pdf in batches:
            out, ids, texts, held = [], [], [], 0
            for ident, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
                if not text or len(text) <= limit and len(text.encode("utf-8")) <= limit:
                    n, size = len(text or ""), c.tokens(text) if sized or not text else None
                    out.append((ident, 0, 1, 0, size, size, 0, n, (text or "") if with_text else None))
                    continue
                ids.append(ident)
                texts.append(text)
                held += len(text)
                if held > BATCH_CHARS:
                    out += split_batch(ids, texts, c, limit, overlap, with_text)
                    ids, texts, held = [], [], 0
            out += split_batch(ids, texts, c, limit, overlap, with_text)
            frame = pd.DataFrame(out, columns=_COLS)
            yield frame.astype({k: "Int64" for k in ("doc_id", "end_token", "n_tokens", "start_char", "end_char")})

    return docs.select("doc_id", "text").mapInPandas(run, _SCHEMA)
