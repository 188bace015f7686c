"""Merging Burrows-Wheeler transforms of shards by iterative interleave refinement.

Texts are read as words over an alphabet of byte blocks: a suffix's first letter is the block of
``BLOCK`` bytes where it starts, and the next letter starts ``BLOCK`` bytes later. A string of
``k * BLOCK`` bytes is then ``k`` letters, and as many rounds tell which suffixes share it.

Each shard's suffixes are sorted once. The merged order is held as one shard number per rank, as
the suffixes of a shard keep their order in it. A round reads, in the present order, the letter
before each suffix and deals the shard numbers out by that letter: the order by ``r`` letters
becomes the order by ``r + 1`` letters, without comparing a suffix again. Ranks that share their
first letters form blocks, which the rounds refine along; they are the repeated intervals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK = 50


def letters(data: np.ndarray, left: np.ndarray, block: int) -> np.ndarray:
    """Rank, from 1, of the block that starts at each place; 0 where less than a block is left.

    ``left`` says how many bytes of the same text begin at each place. Ranks of 1, 2, 4, ... bytes
    are put together from two halves, which may overlap in the last step. They follow the order
    of the blocks' bytes.
    """
    rank, width = data.astype(np.int64) + 1, 1
    while width < block:
        step = min(width, block - width)
        after = np.zeros_like(rank)
        after[: len(rank) - step] = rank[step:]
        pair = rank * (int(rank.max(initial=0)) + 2) + after
        width += step
        pair[left < width] = 0
        rank = _dense(pair)
    return np.where(left >= block, rank, 0)


def _dense(values: np.ndarray) -> np.ndarray:
    """Ranks of values by order, from 1; those that are 0 stay 0."""
    _, rank = np.unique(values, return_inverse=True)
    return rank + (0 if (values == 0).any() else 1)


@dataclass
class Shard:
    """Sorted suffixes of some texts, the letter before each (its transform), and their ends."""

    order: np.ndarray
    before: np.ndarray
    n_ends: int


def sort_shard(letter: np.ndarray, next_place: np.ndarray, places: np.ndarray) -> Shard:
    """Sort the suffixes at ``places`` by their letters, ends first, ties by the place where they end.

    ``next_place`` leads to the suffix without the first letter, or -1 at an end.
    """
    own = np.full(len(letter) + 1, -1, np.int64)
    own[places] = np.arange(len(places))
    follow = np.where(next_place[places] >= 0, own[next_place[places]], -1)
    end = np.arange(len(places))
    jump = follow.copy()
    while (jump >= 0).any():
        more = jump >= 0
        end[more] = end[jump[more]]
        jump = np.where(more, jump[jump], -1)
    rank = letter[places]
    jump = follow.copy()
    while True:
        after = np.where(jump >= 0, rank[jump] + 1, 0)
        finer = _dense(rank * (int(after.max(initial=0)) + 1) + after)
        if finer.max(initial=0) == rank.max(initial=0) and not (jump >= 0).any():
            break
        rank = finer
        if not (jump >= 0).any():
            break
        jump = np.where(jump >= 0, jump[jump], -1)
    order = np.lexsort((end, rank))
    sorted_places = places[order]
    previous = np.zeros(len(letter) + 1, np.int64)
    inner = places[follow >= 0]
    previous[next_place[inner]] = letter[inner]
    return Shard(sorted_places, previous[sorted_places], int((follow < 0).sum()))


def merge(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge the shards' orders by their first ``rounds`` letters.

    Gives the suffixes' places in merged order and a block number for each: two suffixes are in
    the same block if their first ``rounds`` letters agree. Stops early once a round refines nothing.
    """
    owner = np.repeat(np.arange(len(shards), dtype=np.int16), [len(s.order) for s in shards])
    ends = np.repeat(np.arange(len(shards), dtype=np.int16), [s.n_ends for s in shards])
    block = np.zeros(len(owner), np.int64)
    blocks = 1
    read = np.empty(len(owner), np.int64)
    for _ in range(rounds):
        for z, shard in enumerate(shards):
            read[owner == z] = shard.before
        at = np.flatnonzero(read)
        # A stable distribution by letter: letter and present rank in one number.
        dealt = np.sort(read[at] << 32 | at)
        rank, letter = dealt & 0xFFFFFFFF, dealt >> 32
        under = block[rank]
        fresh = np.r_[True, (letter[1:] != letter[:-1]) | (under[1:] != under[:-1])] if len(at) else np.zeros(0, bool)
        owner = np.concatenate([ends, owner[rank]])
        block = np.concatenate([np.zeros(len(ends), np.int64), np.cumsum(fresh)])
        now = int(block[-1]) + 1 if len(block) else 0
        if now == blocks:
            break
        blocks = now
    places = np.empty(len(owner), np.int64)
    for z, shard in enumerate(shards):
        places[owner == z] = shard.order
    return places, block


def repeated_windows(texts: list[bytes], window: int, shard_bytes: int, block: int = BLOCK) -> list[np.ndarray]:
    """For each text the starts of its ``window``-byte strings that start elsewhere in ``texts`` too."""
    if window % block:
        raise ValueError("the window must be whole blocks")
    if not texts:
        return []
    lengths = np.array([len(t) for t in texts], np.int64)
    # One place more than bytes: the end of a text is the empty suffix.
    edges = np.r_[0, np.cumsum(lengths + 1)]
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    text = np.repeat(np.arange(len(texts)), lengths + 1)
    left = edges[text] + lengths[text] - np.arange(len(data))
    letter = letters(data, left, block)
    next_place = np.where(left >= block, np.arange(len(data)) + block, -1)
    shard_of = edges[:-1] // max(1, shard_bytes)
    cuts = np.r_[0, np.flatnonzero(np.diff(shard_of)) + 1, len(texts)]
    shards = [
        sort_shard(letter, next_place, np.arange(edges[a], edges[b])) for a, b in zip(cuts[:-1], cuts[1:]) if a < b
    ]
    places, blocks = merge(shards, window // block)
    whole = left[places] >= window
    places, blocks = places[whole], blocks[whole]
    _, at, count = np.unique(blocks, return_inverse=True, return_counts=True)
    found = np.sort(places[count[at] > 1])
    bounds = np.searchsorted(found, edges)
    return [found[a:b] - e for a, b, e in zip(bounds[:-1], bounds[1:], edges)]
