"""The ledger must say what the operators it stands in for say."""

from __future__ import annotations

import pytest

from orderflume.model import TABLES
from orderflume.operators import contract, ledger, validation
from orderflume.plans.inputs import Inputs


@pytest.fixture(scope="module")
def inputs(spark):
    found = Inputs(spark, "/root/testdata/sf0.001")
    found.prepare("df_orders", "df_order_items", "df_payments")
    return found


@pytest.fixture(scope="module")
def lines(inputs):
    flagged = {t: inputs.flagged(t) for t in ledger.SHORT_NAMES}
    return inputs.stage.put("test_ledger", ledger.order_ledger(flagged))


@pytest.fixture(scope="module")
def summary(lines):
    return ledger.ledger_summary(lines).first().asDict()


@pytest.mark.parametrize("table", ledger.CHILDREN)
def test_child_metrics(inputs, summary, table):
    expected = contract.contract_metrics(
        inputs.flagged(table), TABLES[table], inputs.membership(table)
    )
    assert ledger.child_metrics(summary, table, 0) == expected.first().asDict()


@pytest.mark.parametrize("table", ledger.SHORT_NAMES)
def test_keys(inputs, summary, table):
    expected = validation.key_profile(inputs.flagged(table), ["order_id"]).first()
    assert ledger.key_numbers(summary, table) == tuple(expected)


@pytest.mark.parametrize("table", ledger.CHILDREN)
def test_orphans_and_membership(inputs, lines, summary, table):
    flagged = inputs.flagged(table)
    expected = validation.orphan_count(flagged, inputs.flagged("df_orders")).first().n
    assert summary[f"{ledger.SHORT_NAMES[table]}_orphans"] == expected
    pruned = [
        contract.prune_children(flagged, ids, True).select("order_id")
        for ids in (ledger.ledger_membership(lines, table), inputs.membership(table))
    ]
    assert pruned[0].exceptAll(pruned[1]).isEmpty() and pruned[1].exceptAll(pruned[0]).isEmpty()


def test_null_ids_are_one_line_and_a_lone_item_has_no_parent(spark):
    def flagged(values, table):
        df = spark.createDataFrame(values, "order_id string, _copies bigint, _reason string")
        return {table: df}

    lines = ledger.order_ledger(
        {
            **flagged([("o1", 2, None), ("o2", 1, contract.NULLS)], "df_orders"),
            **flagged([("o1", 1, None), ("o2", 1, None), ("o9", 3, None), (None, 1, contract.NULLS)], "df_order_items"),
            **flagged([("o9", 1, None)], "df_payments"),
        }
    )
    assert lines.where("order_id is null").count() == 1
    summary = ledger.ledger_summary(lines).first().asDict()
    assert (summary["items_orphans"], summary["items_cascade"], summary["items_ghosts"]) == (3, 1, 1)
    assert (summary["orders_repeated_rows"], summary["valid_orders"]) == (1, 1)
    metrics = ledger.child_metrics(summary, "df_order_items", 0)
    assert (metrics["initial_rows"], metrics["final_rows"]) == (6, 1)
