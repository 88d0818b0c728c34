"""SuperMinHash signatures (Ertl 2017) of many sets at once, in numpy."""

from __future__ import annotations

import numpy as np

from plumbline.llm.words import MIXER, mix

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_PIECE = 1 << 16


def signatures(elements: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Signatures (sets x ``size``) of the sets ``elements[first[i]:first[i + 1]]``.

    Every element walks through its own random permutation of the places; at step j it
    offers the rank j plus a random fraction to the next place. A set stops as soon as
    all its places hold a rank below the step, as later offers are larger. Sets are
    handled in pieces of bounded memory; an empty set keeps the largest number everywhere.
    """
    out = np.full((len(first) - 1, size), _EMPTY)
    lo = 0
    while lo < len(out):
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + _PIECE, side="right")) - 1)
        if first[hi] - first[lo] <= 2 * _PIECE:
            out[lo:hi] = _piece(elements[first[lo] : first[hi]], np.diff(first[lo : hi + 1]), size)
        else:  # one very large set: the signature of a union is the minimum of the parts'
            for a in range(first[lo], first[hi], _PIECE):
                part = elements[a : min(a + _PIECE, first[hi])]
                np.minimum(out[lo], _piece(part, np.array([len(part)]), size)[0], out=out[lo])
        lo = hi
    return out


def _piece(elements: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    held = np.full(len(counts) * size, _EMPTY)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.broadcast_to(np.arange(size, dtype=np.uint16), (len(elements), size)).copy()
    live = np.flatnonzero(counts)
    for step in range(size):
        draw = mix(elements + np.uint64((2 * step + 1) * int(MIXER) & 0xFFFFFFFFFFFFFFFF))
        swap = step + ((draw >> np.uint64(32)) * np.uint64(size - step) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(elements))
        target = place[rows, swap]
        place[rows, swap] = place[:, step]
        offer = np.uint64(step << 32) | (draw & np.uint64(0xFFFFFFFF))
        np.minimum.at(held, owner * size + target, offer)
        live = live[held.reshape(-1, size)[live].max(axis=1) >= np.uint64((step + 1) << 32)]
        if not len(live):
            break
        goes_on = np.zeros(len(counts), bool)
        goes_on[live] = True
        keep = goes_on[owner]
        if not keep.all():
            elements, owner, place = elements[keep], owner[keep], place[keep]
    return held.reshape(-1, size)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per set and band (sets x ``bands``); different bands never share a hash by design."""
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(signature), bands)).copy()
    grouped = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    for k in range(rows):
        out = mix(out * MIXER + grouped[:, :, k])
    return out
