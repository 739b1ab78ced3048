"""Straightforward single-row versions of the rules, for small fixtures."""

from decimal import ROUND_HALF_UP, Decimal
from itertools import combinations
import re

from samekin.plans.policy import IDENTIFIER


def two_decimals(value):
    return float(Decimal(repr(value)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def normalize(name):
    name = re.sub(r"[^a-zA-Z0-9\s]", "", name.lower(), flags=re.ASCII)
    return re.sub(r"\s+", " ", name, flags=re.ASCII).replace("0", "O").strip(" ")


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def similarity(a, b):
    if a is None or b is None:
        return 0.0
    a, b = normalize(a), normalize(b)
    longer = max(len(a), len(b))
    return 1.0 if longer == 0 else two_decimals(1.0 - edit_distance(a, b) / longer)


def difference(a, b):
    mean = (abs(a) + abs(b)) / 2.0
    return 0.0 if mean == 0.0 else two_decimals(abs(a - b) / mean)


def control_trim(text):
    return text.strip("".join(map(chr, range(33))))


def matches(left, right, policy):
    """``left`` and ``right`` are dicts with the canonical columns."""
    if difference(left["amount"], right["amount"]) >= policy.amount_relative_tolerance:
        return False
    if abs(left["eventTime"] - right["eventTime"]) > policy.max_step_distance:
        return False
    types = [left["txType"], right["txType"]]
    if policy.require_type_match:
        if None in types or control_trim(types[0]).upper() != control_trim(types[1]).upper():
            return False
    if policy.evidence_mode == IDENTIFIER:
        wallets = [left["wallet"], right["wallet"]]
        same_wallet = None not in wallets and (
            control_trim(wallets[0]).lower() == control_trim(wallets[1]).lower()
        )
        named = similarity(left["name"], right["name"]) >= policy.name_similarity_threshold
        return named or (policy.wallet_match_enabled and same_wallet)
    return True


def keys(row, cap_key=None):
    name = None if row["name"] is None else row["name"].strip(" ").lower()
    amount = None
    if row["txType"] is not None:
        cents = int(Decimal(repr(row["amount"] * 100.0)).quantize(Decimal(1), ROUND_HALF_UP))
        amount = f"amt:{cents}|type:{row['txType']}"
    return name, amount


def matched_pairs(rows, policy, cap=None):
    """Set of (smaller id, larger id) of rows that share a block and match."""
    sizes = {}
    for row in rows:
        sizes[keys(row)[1]] = sizes.get(keys(row)[1], 0) + 1
    found = set()
    for a, b in combinations(rows, 2):
        (name_a, amount_a), (name_b, amount_b) = keys(a), keys(b)
        same_name = name_a is not None and name_a == name_b
        same_amount = amount_a is not None and amount_a == amount_b
        if same_amount and cap is not None and sizes[amount_a] > cap:
            same_amount = False
        if (same_name or same_amount) and a["txId"] != b["txId"] and matches(a, b, policy):
            found.add((min(a["txId"], b["txId"]), max(a["txId"], b["txId"])))
    return found


def components(edges):
    parent = {}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        low, high = sorted([root(a), root(b)])
        parent[high] = low
    return {x: root(x) for x in parent}
