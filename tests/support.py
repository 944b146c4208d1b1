"""Folders and helpers that the test modules share."""

import contextlib

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"  # every query has rows here


def core_queries():
    """The registered queries of the reference's own operators."""
    import __spark_entry__ as E
    from relq.plans.catalog import REGISTRY

    found = E.queries()
    return {name: found[name] for name in REGISTRY}


def rows(df):
    return [tuple(r) for r in df.collect()]


@contextlib.contextmanager
def shuffled_bytes(spark):
    """Yields a function that gives the bytes that stages begun inside have shuffled."""
    context = spark.sparkContext._jsc.sc()
    store, bus = context.statusStore(), context.listenerBus()

    def written():
        bus.waitUntilEmpty(30_000)
        gateway = spark.sparkContext._gateway
        found = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), None)
        return {(found.apply(i).stageId(), found.apply(i).attemptId()): found.apply(i).shuffleWriteBytes() for i in range(found.size())}

    before = written()
    yield lambda: sum(n for k, n in written().items() if k not in before)
