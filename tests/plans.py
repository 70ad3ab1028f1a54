"""Looking at physical plans in tests."""

import re


def explained(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def pushed(df) -> str:
    return " ".join(re.findall(r"PushedFilters: \[(.*)\]", explained(df)))


def read_schema(df) -> str:
    return " ".join(re.findall(r"ReadSchema: struct<(.*)>", explained(df)))


def shuffles(df) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", explained(df), re.M))


def scan_metrics(df) -> dict:
    """Metrics of the file scan of ``df``, which is run for it."""
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()
    found = {}

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name == "FileSourceScanExec":
            metrics = node.metrics().iterator()
            while metrics.hasNext():
                entry = metrics.next()
                found[entry._1()] = entry._2().value()
        if name.endswith("QueryStageExec"):
            visit(node.plan())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(execution.executedPlan())
    return found
