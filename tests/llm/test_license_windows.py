"""Windows of licence passages against a slow version."""

import random
import time
from bisect import bisect_left

import pytest

from screenloom.llm.licenses import TEMPLATES, WHOLE, Passages, bigrams, words_of


def slow_windows(words, name, pairs, need, most, percent):
    """Every window from every hit, set by set."""
    own = list(zip(words, words[1:], strict=False))
    hits = [i for i, b in enumerate(own) if b in pairs]
    for x in range(len(hits) - need + 1):
        begin = hits[x]
        if hits[x + need - 1] - begin >= most:
            continue
        best = None
        for end in hits[x : bisect_left(hits, begin + most)]:
            seen = set(own[begin : end + 1])
            both = len(seen & pairs)
            if 200 * both >= percent * (len(seen) + len(pairs)) and (best is None or both / (len(seen) + len(pairs)) > best[0]):
                best = (both / (len(seen) + len(pairs)), end + 1, both, len(seen))
        if best:
            score, last, both, size = best
            yield both * score, begin, last, name, both, size, len(pairs)


def slow_find(passages, words, percent):
    found = [x for name, pairs, _, need, most in passages.made for x in slow_windows(words, name, pairs, need, most, percent)]
    found.sort(key=lambda x: (-x[0], x[1], x[3]))
    kept = []
    for x in found:
        if all(x[2] <= y[1] or x[1] > y[2] for y in kept):
            kept.append(x)
    return sorted(kept, key=lambda x: x[1])


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_windows_are_those_of_the_slow_version(percent):
    rng = random.Random(percent)
    templates = {f"t{k}": " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 25))) for k in range(6)}
    passages = Passages(templates, percent)
    for _ in range(60):
        words = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            own = list(words_of(rng.choice(list(templates.values()))))
            if rng.random() < 0.5 and own:
                own[rng.randrange(len(own))] = "z"
            at = rng.randint(0, len(words))
            words[at:at] = own
        for name, pairs, _, need, most in passages.made:
            assert sorted(slow_windows(words, name, pairs, need, most, percent)) == sorted(
                x for x in [y for y in passages_windows(passages, words, name)]
            )


def passages_windows(passages, words, name):
    import numpy as np

    (_, pairs, _, need, most), = (m for m in passages.made if m[0] == name)
    own, last, before = list(zip(words, words[1:], strict=False)), {}, []
    for i, b in enumerate(own):
        before.append(last.get(b, -1))
        last[b] = i
    return passages.windows(np.array([b in pairs for b in own], bool), np.array(before, np.int64), name, len(pairs), need, most)


def test_found_passages_are_those_of_the_slow_version():
    rng = random.Random(2)
    passages = Passages(TEMPLATES | WHOLE, 80)
    texts = list((TEMPLATES | WHOLE).values())
    for _ in range(12):
        words = []
        for _ in range(rng.randint(1, 3)):
            words += [f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 30))] + words_of(rng.choice(texts))
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = "other"
        assert passages.find(words) == slow_find(passages, words, 80)


def test_a_long_dump_of_notices_is_quick():
    grant = words_of(next(t for n, t in sorted((TEMPLATES | WHOLE).items()) if "MIT" in n))
    words = grant * (50_000 // len(grant) + 1)
    began = time.perf_counter()
    found = Passages(TEMPLATES | WHOLE, 80).find(words)
    assert found and time.perf_counter() - began < 8
    assert bigrams(grant)
