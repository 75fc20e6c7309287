"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict
from itertools import combinations

BLANKS = rb"[^\x20\x09-\x0D]+"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text: str | None) -> list[bytes]:
    return re.findall(BLANKS, (text or "").encode())


def lowered(data: bytes) -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def repeated(sequences: dict[int, list | bytes], length: int, first_too: bool) -> dict[int, list[bool]]:
    """Which elements lie in a window that occurs again (anywhere, or earlier)."""
    places = defaultdict(list)
    for key in sorted(sequences):
        sequence = sequences[key]
        for i in range(len(sequence) - length + 1):
            places[tuple(sequence[i : i + length])].append((key, i))
    covered = {key: [False] * len(sequence) for key, sequence in sequences.items()}
    for found in places.values():
        if len(found) > 1:
            for key, i in found if first_too else found[1:]:
                covered[key][i : i + length] = [True] * length
    return covered


def groups(nodes, links) -> dict:
    """The smallest node each node reaches."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def shingles(text: str | None) -> set:
    found = re.findall(BLANKS, lowered((text or "").encode()))
    if not found:
        return set()
    n = min(5, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)}


def similar_groups(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """Set size and component of every document."""
    sets = {key: shingles(text) for key, text in texts.items()}
    links = [
        (a, b) for a, b in combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = groups(sets, links)
    return {key: (len(sets[key]), found[key]) for key in sets}


def prose(seed: int, n: int, vocabulary: int = 300) -> str:
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randrange(1, 8))) for _ in range(vocabulary)]
    return " ".join(draw.choice(words) for _ in range(n))


#: Texts which every operator must take: null, empty, blanks, one word, ties, long, other scripts.
ODD = [None, "", " \t\n", "a", "a a a a", "x" * 300_000, "Straße Çédille 漢字 İ   z", "a b c", "\U0001f600 " * 50]
