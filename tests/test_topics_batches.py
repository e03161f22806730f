"""Documents that are settled together, in batches of like lengths."""

import numpy as np

from loomframe.operators import topics


def test_batches_hold_every_document_once_and_little_padding():
    lengths = np.random.default_rng(2).integers(1, 400, 500)
    found = list(topics._batches(lengths, 1000))
    assert sorted(np.concatenate(found).tolist()) == list(range(500))
    for batch in found:
        own = lengths[batch]
        assert own.max() == own[0] and own.min() >= 0.8 * own.max() - 1
        assert len(batch) == 1 or len(batch) * own[0] <= 1000


def test_long_and_short_documents_are_settled_as_alone():
    draw = np.random.default_rng(5)
    lengths = np.array([300, 1, 2, 150, 7, 290, 1, 33])
    doc = np.repeat(np.arange(len(lengths)), lengths)
    counts, expected = draw.integers(1, 6, len(doc)).astype(float), draw.random((len(doc), 4)) + 1e-3
    gamma, given, bound = topics._settle(counts, doc, expected, 0.25)
    assert np.allclose(gamma.sum(axis=1), 1 + np.bincount(doc, counts), rtol=1e-3)
    for d in range(len(lengths)):
        own = doc == d
        alone = topics._settle(counts[own], np.zeros(lengths[d], int), expected[own], 0.25)
        assert np.allclose(alone[0][0], gamma[d], rtol=1e-9) and np.allclose(alone[1], given[own], rtol=1e-9)
        assert np.isclose(alone[2][0], bound[d], rtol=1e-12)
