"""The one-pass plans against a row-by-row model that applies one file after another."""

import random

import pytest
from conftest import rows

from lodeworks.operators import merge

PACKAGES = 150


def model(existing, files, action, with_flag):
    """``existing``: list of (key, value, flag); ``files``: lists of such rows."""
    table = list(existing)
    for batch in files:
        flagged = {r[0] for r in batch if with_flag and r[2]}
        live = [r for r in batch if not (with_flag and r[2])]
        if action == "upsert":
            for row in live:
                table = [r for r in table if r[0] != row[0]] + [row]
            table = [r for r in table if r[0] not in flagged]
        else:
            known = {r[0] for r in table}
            table += [r for r in live if r[0] not in known]
    return table


@pytest.mark.parametrize("action", ["upsert", "insert_only"])
@pytest.mark.parametrize("with_flag", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_package_fold_equals_file_by_file(spark, action, with_flag, seed):
    rng = random.Random(seed)
    old, new, want = [], [], []
    for p in range(PACKAGES):
        existing = [(k, f"old{k}", None) for k in rng.sample(range(6), rng.randint(0, 4))]
        files = [
            [(rng.randrange(6), f"{f}.{r}", rng.choice([True, False, None])) for r in range(rng.randint(0, 5))]
            for f in range(rng.randint(1, 4))
        ]
        old += [(p, *row) for row in existing]
        new += [(p, *row, f, r) for f, batch in enumerate(files) for r, row in enumerate(batch)]
        want += [(p, *row) for row in model(existing, files, action, with_flag)]
    rng.shuffle(new)
    ddl = "p int, k int, v string, gone boolean"
    existing = spark.createDataFrame(old, ddl)
    incoming = spark.createDataFrame(new, f"{ddl}, __file_seq int, __row_seq long").repartition(5)
    result = getattr(merge, action)(existing, incoming, ["p", "k"], hard_delete="gone" if with_flag else None)
    assert rows(result) == rows(spark.createDataFrame(want, ddl))
