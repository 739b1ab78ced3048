"""DuckDB SQL with the same results as the queries of the catalog, over the same tables."""

from __future__ import annotations

from samekin import catalog as C
from samekin.plans.policy import IDENTIFIER, DecisionPolicy

TX = """tx as (
  select cast(event_id as varchar) as "txId", c_name as name,
         'U' || cast(user_id as varchar) as wallet, value as amount, event_type as "txType",
         cast(floor(epoch(ts - timestamp '2024-01-01') / 3600) as bigint) as "eventTime"
  from events left join customer on user_id = c_custkey)"""

# The same rows under content ids, as the strict loader gives them; copies are one row.
CONTENT_TX = TX.replace("tx as (", "tx0 as (", 1) + """, tx as (
  select distinct sha256(concat_ws('-', "eventTime", "txType", name, 'M' || "txId", amount))
         as "txId", name, name as wallet, amount, "txType", "eventTime" from tx0)"""

# More rounds than propagation takes here; rows after the first round without changes are left out.
ROUNDS = 30

NAME_KEY = "lower(trim(name, ' '))"
AMOUNT_KEY = (
    "'amt:' || cast(cast(round(amount * 100.0, 0) as bigint) as varchar) || '|type:' || \"txType\""
)


def _normalized(name: str) -> str:
    bare = f"regexp_replace(lower({name}), '[^a-zA-Z0-9\\s]', '', 'g')"
    return f"trim(translate(regexp_replace({bare}, '\\s+', ' ', 'g'), '0', 'O'), ' ')"


PREFIX_KEY = f"substr(regexp_replace({_normalized('name')}, '[^a-z]', '', 'g'), 1, 3)"


def _blocked(key: str, name: str = "b") -> str:
    return f'{name} as (select *, {key} as "blockKey" from tx)'


def _capped(blocked: str, cap: int | None, name: str) -> str:
    if cap is None:
        return f"{name} as (select * from {blocked})"
    return f"""{name} as (
  select * from {blocked} where "blockKey" in
    (select "blockKey" from {blocked} group by "blockKey" having count(*) <= {cap}))"""


def _two_decimals(value: str) -> str:
    # Rounds the shortest decimal form of the double, half away from zero.
    return f"cast(round(cast(cast({value} as varchar) as decimal(38,20)), 2) as double)"


def _pairs(blocked: str) -> str:
    return f"""select l."txId" as "leftTxId", r."txId" as "rightTxId", l."blockKey"
  from {blocked} l join {blocked} r on l."blockKey" = r."blockKey" and l."txId" < r."txId\""""


def _candidates(cap: int | None) -> str:
    """Blocks of both passes and their deduplicated pairs ``c``."""
    return ", ".join(
        [
            TX,
            _blocked(NAME_KEY, "bn"),
            _blocked(AMOUNT_KEY, "ba"),
            _capped("ba", cap, "bc"),
            f"""u as (select *, 'exact_name' as pass from ({_pairs("bn")})
              union all select *, 'amount_type' as pass from ({_pairs("bc")}))""",
            """c as (select "leftTxId", "rightTxId", min("blockKey") as "blockKey",
              string_agg(pass, ',' order by pass desc) as passes
              from u group by 1, 2)""",
        ]
    )


def _scores(pairs: str) -> str:
    left, right = _normalized("l.name"), _normalized("r.name")
    longer = "greatest(length(ln), length(rn))"
    similarity = f"1.0::double - levenshtein(ln, rn)::double / {longer}"
    mean = "((abs(la) + abs(ra)) / 2.0)"
    return f"""f as (
  select p."leftTxId", p."rightTxId", p."blockKey", {left} as ln, {right} as rn,
         l.amount as la, r.amount as ra, lower(trim(l.wallet)) = lower(trim(r.wallet)) as w,
         upper(trim(l."txType")) = upper(trim(r."txType")) as t,
         abs(l."eventTime" - r."eventTime") as d
  from {pairs} p join tx l on l."txId" = p."leftTxId" join tx r on r."txId" = p."rightTxId"),
s as (
  select "leftTxId", "rightTxId",
         case when {longer} = 0 then 1.0 else {_two_decimals(similarity)} end
           as "nameSimilarity",
         w as "walletExactMatch",
         case when {mean} = 0 then 0.0 else {_two_decimals(f"abs(la - ra) / {mean}")} end
           as "amountRelativeDifference",
         "blockKey", t as "typeExactMatch", d as "timeDistance"
  from f)"""


SCORE_COLUMNS = """"leftTxId", "rightTxId", "nameSimilarity", "walletExactMatch",
  "amountRelativeDifference", "blockKey", "typeExactMatch", "timeDistance\""""


def _evidence(policy: DecisionPolicy) -> str:
    """Facts ``s`` to ``e`` with one boolean per kind of evidence and the outcome."""
    type_ok = "type_ok" if policy.require_type_match else "true"
    wallet = '"walletExactMatch"' if policy.wallet_match_enabled else "false"
    strong = "(wallet_ok or name_ok)" if policy.evidence_mode == IDENTIFIER else "required"
    return f"""e0 as (
  select *, {wallet} as wallet_ok,
         "nameSimilarity" >= {policy.name_similarity_threshold} as name_ok,
         "amountRelativeDifference" < {policy.amount_relative_tolerance} as amount_ok,
         "typeExactMatch" as type_ok, "timeDistance" <= {policy.max_step_distance} as step_ok
  from s),
e1 as (select *, amount_ok and step_ok and {type_ok} as required from e0),
e as (select *, {strong} as strong, {strong} and required as matched from e1)"""


def _reasons(policy: DecisionPolicy) -> str:
    def shown(yes, no, ok, value, bound):
        text = f"'(' || cast({value} as varchar) || ',{bound})'"
        return f"case when {ok} then '{yes}' else '{no}' end || {text}"

    name = shown(
        "NameSimilarityAboveThreshold",
        "NameSimilarityBelowThreshold",
        "name_ok",
        '"nameSimilarity"',
        policy.name_similarity_threshold,
    )
    amount = shown(
        "AmountDeltaWithinTolerance",
        "AmountDeltaAboveTolerance",
        "amount_ok",
        '"amountRelativeDifference"',
        policy.amount_relative_tolerance,
    )
    step = shown(
        "StepWithinWindow",
        "StepOutsideWindow",
        "step_ok",
        '"timeDistance"',
        policy.max_step_distance,
    )
    return f"""list_sort(list_filter([
    case when wallet_ok then 'ExactWalletMatch' end, {name}, {amount}, {step},
    case when type_ok then 'TypeMatched' else 'TypeMismatched' end,
    case when not strong then 'InsufficientEvidence' end], lambda x: x is not null))"""


def _decided(policy: DecisionPolicy, cap: int | None = None) -> str:
    return f"{_candidates(cap)}, {_scores('c')}, {_evidence(policy)}"


DECISION = "case when matched then 'MATCHED' else 'NOT_MATCHED' end"


def _decisions(policy: DecisionPolicy) -> str:
    return f"""with {_decided(policy)}
select "leftTxId", "rightTxId", array_to_string({_reasons(policy)}, ';') as reasons,
       {DECISION} as decision, '{policy.policy_version}' as "policyVersion" from e"""


def _summary(policy: DecisionPolicy) -> str:
    return f"""with {_decided(policy)}
select decision, reason, count(*) as pairs from (
  select {DECISION} as decision, regexp_replace(unnest({_reasons(policy)}), '\\(.*$', '') as reason
  from e) group by 1, 2"""


def _matched(policy: DecisionPolicy, cap: int | None = None) -> str:
    return f"""{_decided(policy, cap)},
ed as (select distinct "leftTxId" as src, "rightTxId" as dst from e where matched)"""


def _edges(policy: DecisionPolicy, cap: int | None = None) -> str:
    return f"with {_matched(policy, cap)} select src, dst from ed"


def _mapping(policy: DecisionPolicy, cap: int | None = None, hops: int | None = None) -> str:
    """Components ``m``: smallest id reached, over all hops or at most so many."""
    both = "g as (select src, dst from ed union select dst, src from ed)"
    if hops is None:
        reach = """r(id, lab) as (select src, src from g
  union select g.dst, r.lab from r join g on r.id = g.src)"""
    else:
        reach = f"""r(id, lab, h) as (select distinct src, src, 0 from g
  union select g.dst, r.lab, r.h + 1 from r join g on r.id = g.src where r.h < {hops})"""
    return f"""with recursive {_matched(policy, cap)}, {both}, {reach},
m as (select id as "txId", min(lab) as "resolvedEntityId" from r group by id)"""


def _components(policy: DecisionPolicy) -> str:
    return f'{_mapping(policy)} select "txId", "resolvedEntityId" from m'


def _components_prefix(policy: DecisionPolicy) -> str:
    """One pass, by prefix. The rows themselves are joined, as few of the pairs match."""
    strong = "true"
    if policy.evidence_mode == IDENTIFIER:
        left, right = _normalized("l.name"), _normalized("r.name")
        longer = f"greatest(length({left}), length({right}))"
        similarity = _two_decimals(f"1.0::double - levenshtein({left}, {right})::double / {longer}")
        strong = f"""(lower(trim(l.wallet)) = lower(trim(r.wallet))
      or case when {longer} = 0 then 1.0 else {similarity} end >= {policy.name_similarity_threshold})"""
    difference = _two_decimals("abs(l.amount - r.amount) / ((abs(l.amount) + abs(r.amount)) / 2.0)")
    return f"""with recursive {TX}, {_blocked(PREFIX_KEY)},
ed as (select l."txId" as src, r."txId" as dst from b l join b r on l."blockKey" = r."blockKey"
  and upper(trim(l."txType")) = upper(trim(r."txType")) and l."txId" < r."txId"
  and abs(l."eventTime" - r."eventTime") <= {policy.max_step_distance}
  where case when l.amount = 0 and r.amount = 0 then 0.0 else {difference} end
    < {policy.amount_relative_tolerance} and {strong}),
g as (select src, dst from ed union select dst, src from ed),
r(id, lab) as (select src, src from g union select g.dst, r.lab from r join g on r.id = g.src),
m as (select id as "txId", min(lab) as "resolvedEntityId" from r group by id)
select "txId", "resolvedEntityId" from m"""


def _rounds(policy: DecisionPolicy, rounds: int) -> str:
    """Ids whose smallest label within n hops is not the one within n - 1. There is no further
    round after one without changes."""
    return f"""{_mapping(policy, hops=rounds)},
k as (select id, n.n, min(lab) filter (where h <= n.n) as now,
             min(lab) filter (where h <= n.n - 1) as before
      from r cross join (select unnest(range(1, {rounds + 1})) as n) n group by id, n.n),
c2 as (select n as iteration, count(*) filter (where now <> before) as changed from k group by n)
select iteration, changed from c2 qualify coalesce(lag(changed) over (order by iteration), 1) > 0"""


def _report(policy: DecisionPolicy) -> str:
    return f"""{_mapping(policy)},
a as (select "resolvedEntityId", cast(sum(cast(amount as decimal(30,8))) as double) as total,
             count(*) as n, count(distinct wallet) as ids
      from tx join m using ("txId") group by 1),
rep as (select "resolvedEntityId", total as "totalAmount",
       format('{{:,}}', cast(round_even(total, 0) as bigint)) as "totalAmountFmt",
       n as "numberOfTxns", ids as "distinctIdsMerged" from a)"""


TOP_ORDER = """order by "totalAmount" desc, "distinctIdsMerged" desc, "numberOfTxns" desc,
  "resolvedEntityId\""""


def _funnel(policy: DecisionPolicy) -> str:
    return f"""{_mapping(policy)}
select 'transactions' as stage, count(*) as rows from tx
union all select 'pairs_' || pass, count(*) from u group by pass
union all select 'pairs_deduplicated', count(*) from c
union all select 'matched_pairs', count(*) from ed
union all select 'resolved_transactions', count(*) from m
union all select 'resolved_entities', count(distinct "resolvedEntityId") from m"""


def _tx(select: str, *parts: str) -> str:
    return f"with {', '.join([TX, *parts])} {select}"


def oracle_sql() -> dict[str, str]:
    canonical = 'select "txId", name, wallet, amount, "txType", "eventTime" from tx'
    hashed = """select sha256(concat_ws('-', "eventTime", "txType", name, 'M' || "txId", amount))
  as "txId", name, name as wallet, amount, "txType", "eventTime" from tx"""
    keys = 'select "txId", "blockKey" from b'
    top = f"""select "blockKey", count(*) as "count" from b group by 1
  order by 2 desc, 1 limit {C.TOP_N}"""
    cap = C.SMALL_CAP
    sized = _blocked(NAME_KEY)
    identifier_wide = C.IDENTIFIERS.with_(max_step_distance=72)
    return {
        "canonical_transactions": _tx(canonical),
        "hashed_tx_id": _tx(hashed),
        "positional_tx_id": _tx('select count(*) as rows, count(*) as "distinctIds" from tx'),
        "csv_roundtrip": _tx('select name, name as wallet, amount, "txType", "eventTime" from tx'),
        "csv_rejects": _tx(
            """select case when cast("txId" as bigint) % 7 = 0 then 'rejected' else 'accepted' end as kind,
  count(*) as lines, count(*) as whole from tx group by 1"""
        ),
        "csv_strict_roundtrip": _tx(hashed),
        "parquet_roundtrip": _tx(canonical),
        "normalized_names": _tx(f'select "txId", {_normalized("name")} as "normalizedName" from tx'),
        "prefix_block_keys": _tx(keys, _blocked(PREFIX_KEY)),
        "block_keys_name": _tx(keys, _blocked(NAME_KEY)),
        "block_keys_amount": _tx(keys, _blocked(AMOUNT_KEY)),
        "block_sizes_amount": _tx(
            'select "blockKey", count(*) as "count" from b group by 1', _blocked(AMOUNT_KEY)
        ),
        "top_blocks_name": _tx(top, _blocked(NAME_KEY)),
        "top_blocks_amount": _tx(top, _blocked(AMOUNT_KEY)),
        "cap_blocks": _tx(
            'select "txId", "blockKey" from k', _blocked(AMOUNT_KEY), _capped("b", cap, "k")
        ),
        "cap_hit_rate": _tx(
            f"""select count(*) as "totalBlocks", count(*) filter (where n > {cap})
  as "affectedBlocks", count(*) filter (where n > {cap})::double / count(*)::double * 100.0
  as "hitRatePct" from (select count(*) as n from b group by "blockKey")""",
            _blocked(AMOUNT_KEY),
        ),
        "subblock": _tx(
            f"""select "txId", case when count(*) over (partition by "blockKey") > {cap}
  then "blockKey" || '|sub:' || "txType" else "blockKey" end as "blockKey" from b""",
            sized,
        ),
        "pairs_name": _tx(_pairs("b"), sized),
        "pairs_amount": _tx(_pairs("b"), _blocked(AMOUNT_KEY)),
        "pairs_union_dedup": f"""with {_candidates(None)}
select "leftTxId", "rightTxId", "blockKey" from c""",
        "pairs_deduped": f"""with {_candidates(None)}
select "leftTxId", "rightTxId", "blockKey", passes from c""",
        "similarity_scores": f"""with {_candidates(None)}, {_scores("c")}
select {SCORE_COLUMNS} from s""",
        "similarity_scores_amount": _tx(
            f"select {SCORE_COLUMNS} from s",
            _blocked(AMOUNT_KEY),
            f"p0 as ({_pairs('b')})",
            _scores("p0"),
        ),
        "decisions_behavioral": _decisions(C.STANDARD),
        "decisions_identifier": _decisions(C.IDENTIFIERS),
        "decision_summary": _summary(C.WIDE),
        "matched_edges": _edges(C.WIDE),
        "matched_edges_fast": _edges(C.WIDE),
        "matched_edges_capped": _edges(C.WIDE, cap),
        "content_id_edges": _edges(C.WIDE).replace(TX, CONTENT_TX),
        "matched_edges_identifier": _edges(C.IDENTIFIERS),
        "match_count": f"""with {_matched(C.WIDE)}
select 'matched_pairs' as stage, count(*) as rows from ed""",
        "components_converged": _components(C.WIDE),
        "components_prefix": _components_prefix(C.STANDARD),
        "components_loose": _components(C.LOOSE),
        "components_identifier": _components(identifier_wide),
        "components_identifier_prefix": _components_prefix(identifier_wide),
        "components_grown": _components(C.WIDE),
        "components_propagated": _components(C.WIDE),
        "propagation_rounds": _rounds(C.WIDE, ROUNDS),
        "entity_sizes": f"""{_mapping(C.WIDE)}
select "resolvedEntityId", count(*) as "count" from m group by 1""",
        "entity_report": f"{_report(C.WIDE)} select * from rep",
        "bucketed_entity_report": f"{_report(C.WIDE)} select * from rep",
        "top_entities": f"{_report(C.WIDE)} select * from rep {TOP_ORDER} limit {C.TOP_N}",
        "top_entities_propagated": f"{_report(C.WIDE)} select * from rep {TOP_ORDER} limit {C.TOP_N}",
        "stage_funnel": _funnel(C.WIDE),
    }
