"""The snapshot itself."""

from retentia.plans.churn_base import COLUMNS, churn_base
from retentia.queries.registry import query


@query("churn_base", f"SELECT {', '.join(COLUMNS)} FROM churn_base")
def _(spark, sf):
    return churn_base(spark, sf)
