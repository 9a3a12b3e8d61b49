"""Every SURVEY section 2 inventory id is mapped in the README inventory table."""

import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FAMILIES = {"S": 11, "P": 19, "J": 8, "A": 23, "W": 5, "O": 8, "U": 3, "F": 13, "C": 10, "G": 12}


def _covered(inventory: str, family: str, n: int) -> bool:
    for cell in re.findall(r"^\| ([^|]+) \|", inventory, re.M):
        for part in cell.split(","):
            m = re.match(r"([A-Z])(\d+)(?:[–-][A-Z]?(\d+))?$", part.strip())
            if m and m.group(1) == family and int(m.group(2)) <= n <= int(m.group(3) or m.group(2)):
                return True
    return False


def test_every_inventory_id_is_mapped():
    text = open(os.path.join(ROOT, "README.md"), encoding="utf-8").read()
    inventory = text[text.index("## Operator inventory"):text.index("## Design for scale")]
    missing = [f"{f}{i}" for f, n in FAMILIES.items() for i in range(1, n + 1) if not _covered(inventory, f, i)]
    assert not missing


def test_registered_query_ids_are_known():
    import __spark_entry__  # noqa: F401  (registers the queries)
    from civicstat.plans.registry import all_queries
    for q in all_queries().values():
        for i in q.ids.split():
            f, n = i[0], int(i[1:])
            assert f in FAMILIES and 1 <= n <= FAMILIES[f], (q.name, i)
