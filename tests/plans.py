"""Look into executed plans."""


def run_plan(df):
    """Run a frame and return its final physical plan."""
    df.write.format("noop").mode("overwrite").save()
    query = df._jdf.queryExecution()
    df._jdf.queryExecution().executedPlan().execute().count()
    return query.executedPlan()


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _children(node):
    for name in ("executedPlan", "plan"):
        if node.getClass().getSimpleName() in ("AdaptiveSparkPlanExec",) and name == "executedPlan":
            return [node.executedPlan()]
        if node.getClass().getSimpleName().endswith("QueryStageExec") and name == "plan":
            return [node.plan()]
    children = node.children()
    return [children.apply(i) for i in range(children.size())]


def scans(node):
    found = [node] if node.getClass().getSimpleName() == "FileSourceScanExec" else []
    for child in _children(node):
        found += scans(child)
    return found


def metric(node, name: str) -> int:
    return node.metrics().apply(name).value()
