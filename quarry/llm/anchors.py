"""Content-chosen anchors: where equal windows of text can only meet.

Of the hashes of the ``k``-byte grams inside a window, the leftmost least one is
the window's anchor; equal windows choose equal anchors at equal places.  All
consecutive windows with one anchor are a run, and the bytes they cover are the
run's segment.
"""

from __future__ import annotations

import numpy as np

from quarry.llm import _text

GRAM = 64
_PLACE = np.uint64((1 << 26) - 1)


def runs(raw: np.ndarray, off: np.ndarray, length: int, k: int = GRAM) -> dict[str, np.ndarray]:
    """For a buffer of texts: text, start, n (windows), anchor place (in the text), anchor hash and segment hash of every run."""
    none = {"row": np.zeros(0, np.int64), "start": np.zeros(0, np.int64), "n": np.zeros(0, np.int64), "place": np.zeros(0, np.int64), "anchor": np.zeros(0, np.uint64), "segment": np.zeros(0, np.uint64)}
    n = len(raw) - length + 1
    if n <= 0:
        return none
    power, inverse = _text.powers(len(raw) + 1), _text.inverse_powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    gram = _text.mix((total[k:] - total[:-k]) * inverse[: len(raw) - k + 1])
    w = length - k + 1
    least = (gram & ~_PLACE) | (np.arange(len(gram), dtype=np.uint64) & _PLACE)
    wide = 1
    while wide * 2 <= w:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    least = np.minimum(least[:n], least[w - wide : w - wide + n]) if wide < w else least[:n]
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    whole = np.arange(n) + length <= off[row + 1]
    at = np.flatnonzero(whole)
    if len(at) == 0:
        return none
    edge = np.r_[True, (least[at[1:]] != least[at[:-1]]) | (row[at[1:]] != row[at[:-1]])]
    first = at[edge]
    size = np.diff(np.append(np.flatnonzero(edge), len(at)))
    place = (least[first] & _PLACE).astype(np.int64) + (first // (1 << 26)) * (1 << 26)
    place = np.where(place < first, place + (1 << 26), place)
    end = first + size + length - 1
    # a least hash is small, so it is mixed again to be spread evenly
    segment = _text.mix((total[end] - total[first]) * inverse[first] + size.astype(np.uint64) * _text.MULT)
    return {"row": row[first], "start": first - off[row[first]], "n": size, "place": place - off[row[first]], "anchor": _text.mix(gram[place] + _text.MULT), "segment": segment}
