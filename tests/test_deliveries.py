"""What the two deliveries of pipeline_second_run read."""

from starloom.plans.catalogue import FirstDelivery
from starloom.sources.retail_tables import RetailTables


def test_sign_up_dates_are_not_copied_into_a_filter(spark, small):
    clients = FirstDelivery(spark, small).clients()
    plan = clients._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "date_format" in line]
    everyone = RetailTables(spark, small).clients()
    assert clients.columns == everyone.columns and 0 < clients.count() < everyone.count()
