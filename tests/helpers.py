"""Plain Python replay of a change log, the meaning the set-based jobs must match."""

import random

from cdcspark.functions.lsn import LSN, OP

FEED = f"`{OP}` int, `{LSN}` binary, k int, v string"
TABLE = "k int, v string"


def position(n):
    return n.to_bytes(10, "big")


def feed_of(spark, log):
    """``log``: (number, op, key, value)."""
    return spark.createDataFrame([(op, position(n), k, v) for n, op, k, v in log], FEED)


def rows_of(df):
    return sorted(((r["k"], r["v"]) for r in df.collect()), key=repr)


def replay(target, log, mode):
    rows = [tuple(r) for r in target]
    for _, op, k, v in sorted(log, key=lambda e: e[0]):
        hit = [r for r in rows if k is not None and r[0] == k]
        if op == 2:
            if mode == "bag" or k is None or not hit:
                rows.append((k, v))
            elif mode == "upsert":
                rows = [r for r in rows if r[0] != k] + [(k, v)]
        elif op == 4 and k is not None:
            if mode == "upsert":
                rows = [r for r in rows if r[0] != k] + [(k, v)]
            else:
                rows = [(k, v) if r[0] == k else r for r in rows]
        elif op == 1 and k is not None:
            rows = [r for r in rows if r[0] != k]
    return sorted(rows, key=repr)


def random_log(seed, *, events=300, keys=40, nulls=True):
    draw = random.Random(seed)
    log = []
    for n in range(1, events + 1):
        hot = draw.random() < 0.3
        k = 7 if hot else draw.randrange(keys)
        if nulls and draw.random() < 0.03:
            k = None
        v = None if draw.random() < 0.05 else f"v{n}"
        log.append((n, draw.choice([1, 2, 2, 3, 4, 4]), k, v))
    draw.shuffle(log)
    return log


def random_target(seed, *, unique=True, keys=40):
    draw = random.Random(seed + 1000)
    if unique:
        return [(k, f"t{k}") for k in range(0, keys + 10) if draw.random() < 0.5]
    return [(draw.randrange(keys), f"t{i}") for i in range(60)] + [(7, "same")] * 20 + [(None, "n")]
