"""Register of checked queries and their oracle SQL."""

import functools
import textwrap

from auditloom.session import prepare

QUERIES = {}
ORACLES = {}


def query(name, oracle=None):
    """Register `fn(spark, sf_dir)` under `name`, with its oracle if there is one."""

    def add(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = textwrap.dedent(oracle).strip()
        return run

    return add
