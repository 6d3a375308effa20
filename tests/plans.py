"""What executed plans have read."""


def scanned(df, folder):
    """Partitions and files that the scan of a folder has read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, found = [plan], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and folder in node.relation().location().rootPaths().head().toString():
            metrics = node.metrics()
            found.append((metrics.apply("numPartitions").value(), metrics.apply("numFiles").value()))
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return found
