"""What a run really read and moved, from Spark's own counters."""

from __future__ import annotations

import re


def counters(spark, run) -> list[tuple[str, str, dict[str, int]]]:
    """(operator, description, counters) of every operator of the queries ``run`` executes."""
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()

    def known() -> set[int]:
        executions = store.executionsList()
        return {executions.apply(at).executionId() for at in range(executions.size())}

    # By number: of very many executions the store forgets the first, so their count stands still.
    before = known()
    run()
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    out = []
    for number in sorted(known() - before):
        values, nodes = store.executionMetrics(number), store.planGraph(number).allNodes()
        for i in range(nodes.size()):
            node, found = nodes.apply(i), {}
            for j in range(node.metrics().size()):
                metric = node.metrics().apply(j)
                text = values.get(metric.accumulatorId())
                number_of = re.match(r"[\d,]+$", text.get()) if text.isDefined() else None
                if number_of:
                    found[metric.name()] = int(number_of[0].replace(",", ""))
            out.append((node.name(), node.desc(), found))
    return out


def files_read(spark, run, path: str) -> int:
    """Files that scans of a folder read."""
    return sum(found.get("number of files read", 0) for name, desc, found in counters(spark, run)
               if name.startswith("Scan") and path in desc)


def rows_moved(spark, run, key: str) -> int:
    """Rows written to shuffles by a key."""
    return sum(found.get("shuffle records written", 0) for name, desc, found in
               counters(spark, run) if name == "Exchange" and key in desc)
