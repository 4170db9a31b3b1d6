"""Customer tables made by rule: all 21 columns as text, with a target that can be learned."""

from __future__ import annotations

import csv
from pathlib import Path

from rowan.spec import CUSTOMER_SPEC

COLUMNS = CUSTOMER_SPEC.required
SCHEMA = ", ".join(f"`{c}` string" for c in COLUMNS)


def row(i: int, **changes: str | None) -> dict[str, str | None]:
    values: dict[str, str | None] = {}
    for place, (name, allowed) in enumerate(CUSTOMER_SPEC.allowed.items()):
        values[name] = allowed[(i // (place + 1) + i * place) % len(allowed)]
    tenure = 1 + i * 37 % 72
    monthly = 20 + i * 53 % 9000 / 100
    risky = tenure < 24 if i % 7 else tenure >= 24
    values |= {
        "customerID": f"{i:05d}",
        "SeniorCitizen": str(i * 5 % 3 // 2),
        "tenure": str(tenure),
        "MonthlyCharges": f"{monthly:.2f}",
        "TotalCharges": f"{tenure * monthly:.2f}" if i % 11 else " ",
        "Churn": "Yes" if risky else "No",
    }
    return values | changes


def rows(n: int) -> list[dict[str, str | None]]:
    return [row(i) for i in range(n)]


def table(spark, records):
    data = [tuple(r.get(c) for c in COLUMNS) for r in records]
    return spark.createDataFrame(data, SCHEMA)


def write_csv(path: Path, records) -> str:
    with path.open("w", newline="") as f:
        writer = csv.DictWriter(f, fieldnames=list(COLUMNS))
        writer.writeheader()
        writer.writerows({c: "" if r.get(c) is None else r[c] for c in COLUMNS} for r in records)
    return str(path)
