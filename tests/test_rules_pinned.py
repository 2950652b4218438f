"""The rule sets are contract values: names, texts and order are pinned."""

import hashlib

from changelake.plans.specs import SPECS

# Rules per table and the digest of "table|name|text" lines.
COUNTS = {"dim_customer": 5, "dim_product": 6, "fact_orders": 4,
          "fact_order_items": 8, "fact_payments": 8, "fact_shipments": 8}
DIGEST = "15a869f25a532c05d8e871811c8abad40885a3f23bb0f76fab6b6e313d633bd7"


def test_rules_are_the_contract():
    assert {t: len(s.rules) for t, s in SPECS.items()} == COUNTS
    lines = [f"{t}|{n}|{x}" for t in SPECS for n, x in SPECS[t].rules.items()]
    assert len(lines) == 39
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == DIGEST
