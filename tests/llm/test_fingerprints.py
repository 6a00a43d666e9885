import hashlib
import math
import random
from collections import Counter

import numpy as np

from vecshoal.llm import fingerprints

from .conftest import EDGE


def jaccard(a, b):
    weigh = lambda text: {w: 1 + math.log(c) for w, c in Counter(text.split()).items()}
    x, y = weigh(a), weigh(b)
    terms = x.keys() | y.keys()
    return sum(min(x.get(t, 0), y.get(t, 0)) for t in terms) / sum(max(x.get(t, 0), y.get(t, 0)) for t in terms)


def test_collisions_estimate_the_generalised_similarity(prose):
    rng = random.Random(1)
    sampler = fingerprints.Sampler(2048, remember=4000)
    for text, other in zip(prose(8, seed=1), prose(8, seed=2)):
        words = text.split()
        cut = rng.randrange(len(words) // 4, len(words))
        mixed = " ".join([*words[:cut], *other.split()[: len(words) - cut], *words[:5] * 3])
        true, told = jaccard(text, mixed), fingerprints.likeness(sampler(text), sampler(mixed))
        assert abs(true - told) < 4 * math.sqrt(true * (1 - true) / 2048) + 0.01


def test_draws_do_not_depend_on_what_came_before(prose):
    texts = prose(60, seed=3)
    small, fresh = fingerprints.Sampler(32, remember=150), fingerprints.Sampler(32, remember=50_000)
    assert all((small(t) == fresh(t)).all() for t in texts)
    long = " ".join(f"w{n}" for n in range(20_000))
    assert (small(long) == fresh(long)).all()


def test_pairs_edits_and_order(documents, prose):
    texts = [(7 * n % 101, t) for n, t in enumerate([*EDGE, *prose(60)])]
    rows = {r.doc_id: r for r in fingerprints.compare_edited(documents(texts), rows_per_range=9).collect()}
    ordered = sorted(((d, t or "") for d, t in texts), reverse=True)
    sampler = fingerprints.Sampler()
    assert len(rows) == len(texts)
    for at, (doc_id, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        row = rows[doc_id]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = sampler(text)
        assert row.fingerprint == fingerprints.as_text(own) and row.edited_fingerprint == fingerprints.as_text(sampler(edited))
        assert row.near_edited == fingerprints.likeness(own, sampler(edited))
        assert row.near_next == fingerprints.likeness(own, sampler(following))


def test_edges(documents):
    assert fingerprints.compare_edited(documents([])).count() == 0
    assert fingerprints.fingerprint(documents([])).count() == 0
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (4, "x y z"), (4, "x y z"), (4, "other text"), (1, None)]
    odd = documents(rows).selectExpr("*", "1 as range", "2 as sent", "3 as fingerprint")
    got = fingerprints.compare_edited(odd, rows_per_range=1).collect()
    assert len(got) == len(rows)
    nameless = [r for r in got if r.doc_id is None]
    assert {(r.edited_sha256, r.near_next) for r in nameless} == {(hashlib.sha256(b"a b c d").hexdigest() if False else hashlib.sha256("a b c d e f"[:8].encode()).hexdigest(), 0.0)}
    assert len({r.fingerprint for r in got if r.doc_id == 4}) == 2
    only = fingerprints.compare_edited(documents([(3, "one two three")])).collect()[0]
    assert only.near_next == 1.0
    assert np.isfinite(only.near_edited)
