"""Advanced and advanced-analytics dashboards: search, revolving door,
spend per head, budget tiers, influence network, budget ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.operators.ordering import asc, desc, rank_leq, top_k, top_k_per_group
from civicflow.plans.common import Tables, addresses, entries, identities, labels
from civicflow.plans.registry import query

S = "advanced"
SEARCH_TERM = "0000001"


def like_escape(term: str) -> str:
    """Escape LIKE wildcards so a search term matches literally."""
    return term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


@query("srch_name", section=S, term=SEARCH_TERM, oracle=f"""
SELECT name_text AS name, identity AS kind, city
FROM lobbyist_identity LEFT JOIN address ON address_id = address.id
WHERE name_text ILIKE '%{SEARCH_TERM}%'
ORDER BY name NULLS LAST, kind NULLS LAST, city NULLS LAST LIMIT 50""")
def srch_name(t: Tables, term: str = "") -> DataFrame:
    rows = (t["lobbyist_identity"]
            .filter(F.col("name_text").ilike(f"%{like_escape(term)}%"))
            .select("name_text", "identity", "address_id")
            .join(addresses(t, "city"), "address_id", "left")
            .select(F.col("name_text").alias("name"), F.col("identity").alias("kind"), "city"))
    return top_k(rows, 50, asc("name"), asc("kind"), asc("city"))


@query("rev_distribution", section=S, oracle="""
SELECT gov_function_type, count(*) AS n FROM mv_revolving_door_network
GROUP BY gov_function_type ORDER BY n DESC""")
def rev_distribution(t: Tables) -> DataFrame:
    return (t["mv_revolving_door_network"].groupBy("gov_function_type")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(desc("n"), asc("gov_function_type")))


@query("rev_detail", section=S, oracle="""
SELECT end_year_month AS gov_until, last_name || ', ' || first_name AS person,
       organization_name AS organisation, role, gov_function_type AS former_office
FROM mv_revolving_door_network
ORDER BY end_year_month DESC NULLS FIRST, person NULLS LAST, organisation NULLS LAST, role NULLS LAST,
         former_office NULLS LAST
LIMIT 100""")
def rev_detail(t: Tables) -> DataFrame:
    rows = t["mv_revolving_door_network"].select(
        F.col("end_year_month").alias("gov_until"),
        F.concat("last_name", F.lit(", "), "first_name").alias("person"),
        F.col("organization_name").alias("organisation"), "role",
        F.col("gov_function_type").alias("former_office"))
    return top_k(rows, 100, desc("gov_until"), asc("person"), asc("organisation"), asc("role"),
                 asc("former_office"))


@query("adv_spend_per_head", section=S, oracle="""
SELECT li.name_text AS name,
       CAST(fe.expenses_to_eur AS DOUBLE) / CAST(GREATEST(emp.employee_fte, 1.0) AS DOUBLE) AS spend_per_head
FROM register_entry re
JOIN lobbyist_identity li ON re.id = li.entry_id
JOIN financial_expenses fe ON re.id = fe.entry_id
JOIN employees_involved emp ON re.id = emp.entry_id
WHERE fe.expenses_to_eur IS NOT NULL AND emp.employee_fte > 0
ORDER BY spend_per_head DESC NULLS FIRST, name NULLS LAST LIMIT 15""")
def adv_spend_per_head(t: Tables, k: int = 15) -> DataFrame:
    """Top-k of expenses / max(fte, 1) over every (fiscal row, staff row) pair.

    The ratio grows with the expense and shrinks with the head count, so the
    global top-k pairs use only each entry's k largest expenses and k smallest
    head counts: both sides are cut to k per entry (exact, not a sample)
    before the pairs are formed.
    """
    fe = top_k_per_group(
        t["financial_expenses"].filter(F.col("expenses_to_eur").isNotNull())
        .select("entry_id", "expenses_to_eur"),
        ["entry_id"], k, F.col("expenses_to_eur").desc())
    heads = F.greatest(F.col("employee_fte"), F.lit(1.0)).cast("double")
    emp = top_k_per_group(
        t["employees_involved"].filter(F.col("employee_fte") > 0)
        .select("entry_id", heads.alias("heads")),
        ["entry_id"], k, F.col("heads").asc())
    rows = (entries(t).join(identities(t, "name_text"), "entry_id")
            .join(fe, "entry_id").join(emp, "entry_id")
            .select(F.col("name_text").alias("name"),
                    (F.col("expenses_to_eur").cast("double") / F.col("heads"))
                    .alias("spend_per_head")))
    return top_k(rows, k, desc("spend_per_head"), asc("name"))


TIER_LOW = "Low Budget (<20k)"
TIER_MID = "Mid Budget (20k-100k)"
TIER_HIGH = "High Budget (100k-500k)"
TIER_TOP = "Whales (>500k)"


@query("adv_budget_tiers", section=S, oracle=f"""
SELECT CASE WHEN expenses_to_eur < 20000 THEN '{TIER_LOW}'
            WHEN expenses_to_eur < 100000 THEN '{TIER_MID}'
            WHEN expenses_to_eur < 500000 THEN '{TIER_HIGH}'
            ELSE '{TIER_TOP}' END AS budget_tier,
       COUNT(*) AS value
FROM financial_expenses WHERE expenses_to_eur IS NOT NULL
GROUP BY budget_tier ORDER BY value DESC""")
def adv_budget_tiers(t: Tables) -> DataFrame:
    x = F.col("expenses_to_eur")
    tier = (F.when(x < 20000, TIER_LOW).when(x < 100000, TIER_MID)
            .when(x < 500000, TIER_HIGH).otherwise(TIER_TOP))
    return (t["financial_expenses"].filter(x.isNotNull())
            .groupBy(tier.alias("budget_tier")).agg(F.count(F.lit(1)).alias("value"))
            .orderBy(desc("value")))


def _influence_parts(t: Tables):
    """Pieces of the client → contract → agency → ex-official chain.

    Returns (clients, persons): clients = (entry_id, client) rows of contract
    client organisations; persons = (identity_id, entry_id, agency, ep_person,
    fn_id, via) rows, one per (entrusted person or legal representative) with
    a function.  The OR join ``ep.fn = rgf.id OR lr.fn = rgf.id`` is split
    into its two equi-join branches.
    """
    c = t["contracts"].select(F.col("id").alias("parent_id"), "entry_id")
    ci = t["contract_item"].select(F.col("id").alias("contract_item_id"), "parent_id")
    cc = t["contract_clients"].select(F.col("id").alias("clients_id"), "contract_item_id")
    cco = t["contract_client_org"].select("clients_id", F.col("name").alias("client"))
    clients = cco.join(cc, "clients_id").join(ci, "contract_item_id").join(c, "parent_id") \
        .select("entry_id", "client")
    li = entries(t).join(identities(t, F.col("name_text").alias("agency")), "entry_id")
    ep = t["entrusted_person"].select(
        "identity_id",
        F.concat("last_name", F.lit(", "), "first_name").alias("ep_person"),
        F.col("recent_gov_function_id").alias("ep_fn"))
    lr = t["legal_representative"].select(
        "identity_id", F.col("recent_gov_function_id").alias("lr_fn"))
    rgf = t["recent_government_function"].select(F.col("id").alias("fn_id"),
                                                 F.col("type_label_id").alias("label_id"))
    return clients, li, ep, lr, rgf


@query("adv_influence_network", section=S, oracle="""
WITH deals AS (
    SELECT h.entry_id, org.name AS client
    FROM contract_client_org org JOIN contract_clients k ON k.id = org.clients_id
    JOIN contract_item i ON i.id = k.contract_item_id JOIN contracts h ON h.id = i.parent_id),
firms AS (
    SELECT o.id, o.entry_id, o.name_text AS agency
    FROM lobbyist_identity o JOIN register_entry e ON e.id = o.entry_id),
past AS (
    SELECT g.id, l.de AS former_function
    FROM recent_government_function g LEFT JOIN code_label l ON l.id = g.type_label_id),
hires AS (
    SELECT entry_id, agency, COALESCE(x.last_name || ', ' || x.first_name, agency) AS ex_politician, former_function
    FROM firms JOIN entrusted_person x ON x.identity_id = firms.id JOIN past ON past.id = x.recent_gov_function_id
    UNION
    SELECT entry_id, agency, COALESCE(x.last_name || ', ' || x.first_name, agency), former_function
    FROM firms JOIN legal_representative r ON r.identity_id = firms.id
    JOIN past ON past.id = r.recent_gov_function_id
    LEFT JOIN entrusted_person x ON x.identity_id = firms.id)
SELECT DISTINCT client, agency, ex_politician, former_function FROM deals JOIN hires USING (entry_id)
ORDER BY client NULLS LAST, agency NULLS LAST, ex_politician NULLS LAST, former_function NULLS LAST
LIMIT 100""")
def adv_influence_network(t: Tables, k: int | None = 100) -> DataFrame:
    """DISTINCT (client, agency, ex-politician, former function).

    Branch 1 (ep.fn = rgf.id): the entrusted person's own function; a row
    exists whatever the legal representatives are (LEFT JOIN gives ≥ 1).
    Branch 2 (lr.fn = rgf.id): the representative's function, shown with the
    name of *every* entrusted person of the agency (or the agency name when
    it has none).  Both are de-duplicated before clients are attached.
    """
    clients, li, ep, lr, rgf = _influence_parts(t)
    lr_fns = lr.join(rgf, F.col("lr_fn") == F.col("fn_id")).select("identity_id", "label_id") \
        .distinct()

    def people_of(agencies: DataFrame) -> DataFrame:
        b1 = (agencies.join(ep, "identity_id").join(rgf, F.col("ep_fn") == F.col("fn_id"))
              .select("identity_id", "entry_id", "agency",
                      F.coalesce("ep_person", "agency").alias("ex_politician"), "label_id"))
        ep_names = agencies.join(ep, "identity_id", "left") \
            .select("identity_id", "entry_id", "agency",
                    F.coalesce("ep_person", "agency").alias("ex_politician")).distinct()
        b2 = ep_names.join(lr_fns, "identity_id") \
            .select("identity_id", "entry_id", "agency", "ex_politician", "label_id")
        return (b1.unionByName(b2)
                .join(labels(t, de="former_function"), "label_id", "left")
                .select("entry_id", "agency", "ex_politician", "former_function").distinct())

    clients = clients.distinct()
    if k is None:
        return clients.join(people_of(li), "entry_id") \
            .select("client", "agency", "ex_politician", "former_function").distinct()
    # Rows sort by (client, agency) first and every (client, agency) pair of
    # an agency with an ex-official yields at least one row, so the k result
    # rows use at most the k smallest pairs.  Which agencies have one is
    # known without pairing people (a matched entrusted person or a matched
    # representative); pairs are cut to the k smallest (<= k rows,
    # broadcast), and people are combined only for the chosen agencies:
    # exact, and no other agency's client × person product is formed.
    with_official = (ep.join(rgf, F.col("ep_fn") == F.col("fn_id")).select("identity_id")
                     .unionByName(lr_fns.select("identity_id")))
    agencies = li.join(with_official, "identity_id", "left_semi") \
        .select("entry_id", "agency").distinct()
    pairs = clients.join(agencies, "entry_id")
    best = top_k(pairs.select("client", "agency").distinct(), k, asc("client"), asc("agency")) \
        .select(F.col("client").alias("b_client"), F.col("agency").alias("b_agency"))
    chosen = pairs.join(F.broadcast(best),
                        F.col("client").eqNullSafe(F.col("b_client"))
                        & F.col("agency").eqNullSafe(F.col("b_agency"))) \
        .select("entry_id", "client", "agency")
    people = people_of(li.join(chosen.select("entry_id"), "entry_id", "left_semi"))
    rows = (chosen.join(people.withColumnRenamed("agency", "p_agency"),
                        (chosen["entry_id"] == people["entry_id"])
                        & chosen["agency"].eqNullSafe(F.col("p_agency")))
            .select("client", "agency", "ex_politician", "former_function").distinct())
    return top_k(rows, k, asc("client"), asc("agency"), asc("ex_politician"),
                 asc("former_function"))


@query("adv_budget_rank", section=S, oracle="""
SELECT rank, name AS organisation, expenses AS budget FROM (
    SELECT COALESCE(li.name_text, li.company_name) AS name, fe.expenses_to_eur AS expenses,
           RANK() OVER (ORDER BY fe.expenses_to_eur DESC NULLS LAST) AS rank
    FROM financial_expenses fe JOIN lobbyist_identity li ON fe.entry_id = li.entry_id
) ranked_stats WHERE rank <= 20 ORDER BY rank ASC""")
def adv_budget_rank(t: Tables, k: int = 20) -> DataFrame:
    rows = (t["financial_expenses"].select("entry_id", F.col("expenses_to_eur").alias("budget"))
            .join(identities(t, "name_text", "company_name"), "entry_id")
            .select(F.coalesce("name_text", "company_name").alias("organisation"), "budget"))
    return (rank_leq(rows, "budget", k, "rank")
            .withColumn("rank", F.col("rank").cast("long"))
            .select("rank", "organisation", "budget").orderBy("rank", asc("organisation")))
