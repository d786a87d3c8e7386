from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quaylake.session import local_session, new_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = local_session("8", 4)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # plans are searched for pushed filters
    return spark


@pytest.fixture
def folder(spark):
    """A new folder for the files of one test."""
    return new_folder(spark, "test")


@pytest.fixture
def file_scans(spark):
    """A function that tells of each file scan since the last call how many rows it gave, in order."""
    context, store = spark._jsc.sc(), spark._jsparkSession.sharedState().statusStore()
    seen: set[int] = set()

    def since() -> list[int]:
        context.listenerBus().waitUntilEmpty()
        found, runs = [], store.executionsList()
        for i in range(runs.size()):
            run = runs.apply(i).executionId()
            if run in seen:
                continue
            seen.add(run)
            nodes, values = store.planGraph(run).allNodes(), store.executionMetrics(run)
            for node in (nodes.apply(k) for k in range(nodes.size())):
                if not node.name().startswith("Scan "):
                    continue
                metrics = [node.metrics().apply(k) for k in range(node.metrics().size())]
                rows = [values.get(m.accumulatorId()) for m in metrics if m.name() == "number of output rows"]
                found += [int(r.get().replace(",", "")) for r in rows if r.isDefined()]
        return found

    since()
    return since
