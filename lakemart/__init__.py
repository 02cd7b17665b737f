"""lakemart: a retail mart and near-duplicate notice engine written as Spark plans."""
