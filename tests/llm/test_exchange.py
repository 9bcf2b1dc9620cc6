import numpy as np

from toolloom.llm.exchange import split_keys


def test_steps_grow_with_the_keys_not_the_buckets():
    rng = np.random.default_rng(1)
    for sizes, buckets in (((500, 40), 7), ((500, 0), 10**12), ((0, 30), 1000), ((0, 0), 5), ((3, 3), 1)):
        keys = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in sizes]
        steps = list(split_keys(keys, buckets))
        assert [b for b, _ in steps] == sorted({int(k) % buckets for part in keys for k in part})
        for b, mine in steps:
            for part, m in zip(keys, mine):
                assert part[m].tolist() == [k for k in part.tolist() if k % buckets == b]
