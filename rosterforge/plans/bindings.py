"""The driver's tables in the shape of the raw tables.

The expressions use integer arithmetic and text only and mean the same in Spark and in the
checking engine, so both sides start from identical input. Every row of every table is used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rosterforge.config import Config

REFERENCE_DATE = "2024-01-31"   # the day after the last event

ACCOUNTS = {
    "account_id": "'ACC-' || lpad(cast(c_custkey as string), 7, '0')",
    "company_name": "' ' || c_name || ' '",
    "domain": """case c_custkey % 7 when 0 then 'https://www.cust' when 1 then 'www.cust' else 'Cust' end
        || cast(c_custkey as string) || '.example'""",
    "seed_industry": """case c_custkey % 12 when 0 then 'Software' when 1 then 'Data & Analytics'
        when 2 then 'Cybersecurity' when 3 then 'Fintech' when 4 then 'Healthcare' when 5 then 'Marketing Tech'
        when 6 then 'Sales Tech' when 7 then 'HR Tech' when 8 then 'E-commerce & Retail' when 9 then 'Logistics'
        when 10 then 'Developer Tools' else 'Media' end""",
    "hq_country": """case c_nationkey % 7 when 0 then 'us' when 1 then ' CA ' when 2 then 'GB' when 3 then 'DE'
        when 4 then 'IN' when 5 then 'AU' end""",
    "is_real_domain": "case when c_custkey % 4 = 0 then 'True' else 'False' end",
    "source": "case when c_custkey % 4 = 0 then 'public_list' else 'synthetic' end",
    "source_updated_at": f"cast(date '{REFERENCE_DATE}' - cast(c_custkey % 150 as int) as string)",
    "sim_hiring_data_roles": """case when c_custkey % 10 < 3 then 'True' when c_custkey % 10 < 9 then 'False' end""",
    "sim_months_since_funding": """case when c_custkey % 4 = 0 then cast(c_custkey % 36 + 1 as string)
        when c_custkey % 4 = 1 then cast(c_custkey % 20 as string) || '.5' end""",
    "sim_tech_stack_match": "case when c_custkey % 5 < 2 then 'True' else 'False' end",
}

# two orders in twenty share one address; some addresses are broken or missing
ORDER_BASE = "(o_orderkey - case when o_orderkey % 20 = 19 then 1 else 0 end)"
CONTACTS = {
    "contact_id": "'CON-' || lpad(cast(o_orderkey as string), 8, '0')",
    "account_id": """'ACC-' || lpad(cast(case when o_orderkey % 101 = 7 then 9000000 + o_orderkey
        else o_custkey end as string), 7, '0')""",
    "first_name": f"""case {ORDER_BASE} % 8 when 0 then 'Steven' when 1 then 'Steve' when 2 then 'Martha'
        when 3 then 'Marhta' when 4 then 'Brian' when 5 then 'Bryan' when 6 then 'Jon' else 'John' end""",
    "last_name": f"""case {ORDER_BASE} % 5 when 0 then 'Smith' when 1 then 'smith' when 2 then 'Lee ' when 3 then 'Lin'
        else 'Roe' end""",
    "email": f"""case when o_orderkey % 211 = 3 then null
        when o_orderkey % 20 = 19 then ' USER' || cast({ORDER_BASE} as string) || '@ORG'
            || cast({ORDER_BASE} % 50 as string) || '.TEST '
        when o_orderkey % 33 = 5 then 'user' || cast({ORDER_BASE} as string) || '@@org'
            || cast({ORDER_BASE} % 50 as string) || '.test'
        else 'user' || cast({ORDER_BASE} as string) || '@org' || cast({ORDER_BASE} % 50 as string) || '.test' end""",
    "title": """case o_orderkey % 16 when 0 then '  Data Engineer ' when 1 then 'VP, Revenue Operations'
        when 2 then 'Dir. Data' when 3 then 'Sr. Software Engineer' when 4 then 'head of revops'
        when 5 then 'Chief Operating Officer' when 6 then 'Finance  Manager' when 7 then ''
        when 8 then 'Account Executive' when 9 then 'Growth Marketer' when 10 then 'vp, data'
        when 11 then 'Chief Data Officer' when 12 then 'Sales And Marketing Manager' when 13 then 'Janitor'
        when 14 then 'Vice President Sales' else 'Analytics Manager' end""",
    "source_updated_at": f"cast(date '{REFERENCE_DATE}' - cast(o_orderkey % 400 as int) as string)",
}

# users are a hundredth of the orders: the event number tells the contacts of a user apart
ENGAGEMENT = {
    "event_id": "'EVT-' || lpad(cast(event_id as string), 8, '0')",
    "contact_id": "'CON-' || lpad(cast(user_id * 100 + event_id % 100 as string), 8, '0')",
    "event_type": """case event_type when 'view' then 'web_visit' when 'click' then 'email_open'
        when 'purchase' then 'meeting' when 'signup' then 'reply' else event_type end""",
    "event_ts": "cast(ts as string)",
}

# one customer in ten gets a domain no account has
ENRICHMENT = {
    "domain": """case when c_custkey % 10 = 9 then 'nobody' when c_custkey % 3 = 0 then 'HTTPS://www.cust' else 'cust' end
        || cast(c_custkey as string) || '.example' || case when c_custkey % 6 = 0 then '/' else '' end""",
    "industry": """case c_custkey % 9 when 0 then 'Software Development' when 1 then 'Banking'
        when 2 then 'Computer and Network Security' when 3 then 'Hospitals and Health Care' when 4 then null
        when 5 then 'Space Mining' when 6 then 'Retail' when 7 then 'Data Infrastructure and Analytics'
        else 'Design Services' end""",
    "employee_count": """case c_custkey % 25 when 0 then null when 1 then '2.5' when 2 then '3.5' when 3 then 'n.a.'
        when 4 then '14.0' else cast((c_custkey * 37) % 12000 + 5 as string) end""",
    "hq_country": "case c_custkey % 11 when 0 then null when 1 then ' gb ' else 'US' end",
    "founded_year": "case when c_custkey % 8 = 0 then null else cast(1990 + c_custkey % 30 as string) || '.0' end",
    "size_band": """case c_custkey % 6 when 0 then '1,001-5,000 employees' when 1 then '10,001+ employees'
        when 2 then '51-200 employees' when 3 then null when 4 then '201-500 employees' else 'unknown' end""",
    "description": "'about ' || c_name",
    "matched_name": "c_name",
    "provider": "case when c_custkey % 2 = 0 then 'clay' else 'mock' end",
    "source_file": "case when c_custkey % 2 = 0 then 'clay_batch_01.csv' else 'mock_accounts.csv' end",
    "enriched_at": f"cast(date '{REFERENCE_DATE}' - cast(c_custkey % 120 as int) as string)",
}
# an older answer from the other provider for everyone
OLDER_ENRICHMENT = ENRICHMENT | {
    "industry": "'Entertainment Providers'",
    "provider": "case when c_custkey % 2 = 0 then 'mock' else 'clay' end",
    "source_file": "case when c_custkey % 2 = 0 then 'mock_old.csv' else 'clay_old.csv' end",
    "enriched_at": "'2023-01-01'",
}


# clean tables to plant errors in: unique valid addresses, known accounts, fresh dates, plain titles
CLEAN_CONTACTS = CONTACTS | {
    "account_id": "'ACC-' || lpad(cast(o_custkey as string), 7, '0')",
    "first_name": "'First' || cast(o_orderkey as string)",
    "last_name": "'Last' || cast(o_orderkey as string)",
    "email": "'user' || cast(o_orderkey as string) || '@org' || cast(o_custkey as string) || '.test'",
    "title": """case o_orderkey % 6 when 0 then 'Data Engineer' when 1 then 'VP of Revenue Operations'
        when 2 then 'Director of Data' when 3 then 'Chief Operating Officer' when 4 then 'Finance Manager'
        else 'Sales Manager' end""",
    "source_updated_at": f"cast(date '{REFERENCE_DATE}' - cast(o_orderkey % 150 as int) as string)",
}
# a specific label that fits the seed, a generic one, or none
CLEAN_ENRICHMENT = ENRICHMENT | {
    "domain": "'cust' || cast(c_custkey as string) || '.example'",
    "industry": """case when c_custkey % 5 = 3 then 'Software Development' when c_custkey % 5 = 4 then null
        else case c_custkey % 12 when 0 then 'Design Services' when 1 then 'Data Infrastructure and Analytics'
        when 2 then 'Computer and Network Security' when 3 then 'Financial Services'
        when 4 then 'Hospitals and Health Care' when 5 then 'Marketing Services' when 6 then 'Computer Software'
        when 7 then 'Human Resources Services' when 8 then 'Retail'
        when 9 then 'Transportation, Logistics, Supply Chain and Storage' when 10 then 'Computer Software'
        else 'Entertainment Providers' end end""",
}
CLEAN_ACCOUNTS = ACCOUNTS | {"domain": "'cust' || cast(c_custkey as string) || '.example'"}


def select_list(columns: dict[str, str]) -> list[str]:
    return [f"{expr} as {name}" for name, expr in columns.items()]


@dataclass(frozen=True)
class RawTables:
    accounts: DataFrame
    contacts: DataFrame
    engagement: DataFrame
    enrichment_wide: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str) -> RawTables:
    customer = table(spark, sf_dir, "customer")
    newest = customer.selectExpr(*select_list(ENRICHMENT))
    older = customer.selectExpr(*select_list(OLDER_ENRICHMENT))
    return RawTables(
        accounts=customer.selectExpr(*select_list(ACCOUNTS)),
        contacts=table(spark, sf_dir, "orders").selectExpr(*select_list(CONTACTS)),
        engagement=table(spark, sf_dir, "events").selectExpr(*select_list(ENGAGEMENT)),
        enrichment_wide=newest.unionByName(older),
    )


def bind_clean(spark: SparkSession, sf_dir: str) -> RawTables:
    customer = table(spark, sf_dir, "customer")
    return RawTables(
        accounts=customer.selectExpr(*select_list(CLEAN_ACCOUNTS)),
        contacts=table(spark, sf_dir, "orders").selectExpr(*select_list(CLEAN_CONTACTS)),
        engagement=table(spark, sf_dir, "events").selectExpr(*select_list(ENGAGEMENT)),
        enrichment_wide=customer.selectExpr(*select_list(CLEAN_ENRICHMENT)),
    )


def binding_config(**changes) -> Config:
    return Config(reference_date=REFERENCE_DATE, **changes)
