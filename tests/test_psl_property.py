"""eTLD+1 from the broadcast lookups against a direct implementation of the public-suffix
algorithm, on hosts built from the real rule list (wildcards and exceptions included)."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ctspark.operators.hosts import PublicSuffixTable, psl_path, registered_domain

PSL = psl_path()


def brute_force(host, exact, wild, exc):
    if not host or host.startswith(".") or host.endswith(".") or ".." in host:
        return ""
    labels = host.split(".")
    n = len(labels)
    best = 1
    exception = None
    for j in range(1, n + 1):
        cand = ".".join(labels[-j:])
        if cand in exc:
            exception = j - 1 if exception is None else max(exception, j - 1)
        if cand in exact:
            best = max(best, j)
        if cand in wild and n >= j + 1:
            best = max(best, j + 1)
    suffix = exception if exception is not None else best
    return ".".join(labels[-(suffix + 1):]) if n > suffix else ""


@pytest.mark.skipif(PSL is None or not os.path.exists(PSL), reason="no system public-suffix list")
def test_registered_domain_matches_direct_algorithm(spark):
    exact, wild, exc = set(), set(), set()
    for line in open(PSL, encoding="utf-8"):
        r = line.strip().split(" ")[0] if line.strip() else ""
        if not r or r.startswith("//") or not r.isascii():
            continue
        r = r.lower()
        if r.startswith("!"):
            exc.add(r[1:])
        elif r.startswith("*."):
            wild.add(r[2:])
        else:
            exact.add(r)
    rnd = random.Random(11)
    rules = sorted(exact | wild | exc)
    hosts = []
    for _ in range(3000):
        base = rnd.choice(rules)
        extra = [rnd.choice(["www", "a", "b-c", "x1"]) for _ in range(rnd.randrange(0, 3))]
        hosts.append(".".join(extra + [base]))
    hosts += ["com", "", "a..com", "zz", "x.y.zz"]
    psl = PublicSuffixTable(spark)
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = {r.h: r.domain for r in registered_domain(df, "h", psl).collect()}
    wrong = [(h, got[h], brute_force(h, exact, wild, exc)) for h in hosts if got[h] != brute_force(h, exact, wild, exc)]
    assert not wrong, wrong[:10]
