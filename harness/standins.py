"""Stand-ins for registry, directory, claims and list data.

Keys are taken from table keys, so every stand-in grows with its tables and
no group grows with the whole.
"""

from __future__ import annotations

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_PANEL_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"
_QUARTER = "CAST(date_trunc('quarter', l_shipdate) AS DATE)"

# group number of a person's n-th place: 20 people share one
_DIR_G = "(CAST(floor(l_partkey / 20) AS BIGINT) * 3 + l_suppkey % 3)"
_LOC_G = "(CAST(floor(o_custkey / 20) AS BIGINT) * 3 + o_orderkey % 3)"


def _state(g: str) -> str:
    return f"'S' || CAST({g} % 40 AS STRING)"


def _zip(g: str) -> str:
    return f"lpad(CAST({g} % 90000 AS STRING), 5, '1') || '0001'"


def _phone(g: str, k: str = "0") -> str:
    return f"lpad(CAST({g} * 2 + {k} AS STRING), 10, '5')"


STANDINS: dict[str, str] = {
    # ------------------------------------------------------------- registry
    "panel": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month, o_orderkey AS rid,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS value,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status
        FROM {{orders}}""",
    "entity_panel": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL
                    WHEN o_custkey % 5 = 0 THEN 2 ELSE 1 END AS entity
        FROM {{orders}}""",
    "entity": """
        SELECT c_custkey AS npi, CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END AS entity
        FROM {customer}""",
    "deact_panel": """
        SELECT user_id AS npi, CAST(ts AS DATE) AS npideactdate FROM {events}
        WHERE event_type = 'error'""",
    "react_panel": """
        SELECT user_id AS npi, CAST(ts AS DATE) AS npireactdate FROM {events}
        WHERE event_type = 'signup'""",
    "ends": """
        SELECT c_custkey * 2 AS npi,
               CAST(DATE '1996-01-01' + CAST(c_custkey % 60 AS INT) * INTERVAL 1 MONTH AS DATE)
                   AS npideactdate
        FROM {customer}""",
    "weekly": """
        SELECT user_id AS npi, CAST(date_trunc('week', ts) AS DATE) AS week,
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS value
        FROM {events}""",
    "monthly": """
        SELECT DISTINCT user_id + 40 AS npi, CAST(date_trunc('month', ts) AS DATE) AS month,
               'stored' AS value
        FROM {events}""",
    "slots": """
        SELECT c_custkey AS npi,
               CASE WHEN c_custkey % 2 = 0 THEN 'A' || CAST(c_nationkey AS STRING) END AS code_1,
               CASE WHEN c_custkey % 3 = 0 THEN 'B' || CAST(c_nationkey AS STRING) END AS code_2,
               c_mktsegment AS code_3,
               CASE WHEN c_custkey % 5 = 0 THEN 'D' || CAST(c_custkey AS STRING) END AS code_10
        FROM {customer}""",
    "taxonomy": """
        SELECT DISTINCT 'T' || CAST(p_size AS STRING) AS TaxonomyCode,
          CASE WHEN p_size % 17 IN (0, 1, 2) THEN 'Allopathic & Osteopathic Physicians'
               WHEN p_size % 17 IN (3, 4) THEN 'Nursing Service Providers'
               WHEN p_size % 17 IN (5, 6) THEN 'Nursing Service Related Providers'
               ELSE 'Other Providers' END AS Type,
          CASE p_size % 17 WHEN 0 THEN 'Family Medicine' WHEN 1 THEN 'Internal Medicine'
               WHEN 2 THEN 'Surgery' WHEN 3 THEN 'Registered Nurse'
               WHEN 4 THEN 'Licensed Practical Nurse' WHEN 5 THEN 'Registered Nurse'
               WHEN 6 THEN 'Nursing Aide' WHEN 7 THEN 'Nurse Practitioner'
               WHEN 8 THEN 'Physician Assistant' WHEN 9 THEN 'Clinical Nurse Specialist'
               WHEN 10 THEN 'Advanced Practice Midwife'
               WHEN 11 THEN 'Nurse Anesthetist, Certified Registered'
               WHEN 12 THEN 'Chiropractor' WHEN 13 THEN 'Dentist' WHEN 14 THEN 'Podiatrist'
               WHEN 15 THEN 'Pharmacist' ELSE 'Specialist' END AS Classification,
          CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 17 = 0 THEN 'General Practice'
               WHEN p_size % 5 = 0 THEN 'Adult -'
               ELSE 'Branch ' || CAST(p_size % 6 AS STRING) END AS Specialization
        FROM {part}""",
    "code_panel": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month,
               CASE WHEN o_orderkey % 23 = 0 THEN '390200000X'
                    ELSE 'T' || CAST(o_orderkey % 60 AS STRING) END AS ptaxcode
        FROM {{orders}}""",
    "cred_panel": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month,
               CASE o_custkey % 8 WHEN 0 THEN 'M.D.' WHEN 1 THEN 'md, PhD' WHEN 2 THEN 'N.P., RN'
                    WHEN 3 THEN 'D.O.' WHEN 4 THEN NULL WHEN 5 THEN 'fnp-bc'
                    WHEN 6 THEN 'P A, Esq.' ELSE 'R.N.' END AS pcredential
        FROM {{orders}}""",
    "credoth_panel": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month,
               CASE WHEN o_custkey % 6 = 1 THEN 'CRNA' WHEN o_custkey % 6 = 2 THEN 'DDS'
                    WHEN o_custkey % 6 = 3 THEN 'NP' END AS pcredentialoth
        FROM {{orders}}""",
    "licence_state": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month, CAST(1 + o_orderkey % 3 AS INT) AS seq,
               max('S' || CAST(o_orderkey % 7 AS STRING)) AS PLICSTATE
        FROM {{orders}}
        GROUP BY 1, 2, 3""",
    "licence_number": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month, CAST(1 + o_orderkey % 4 AS INT) AS seq,
               max('L' || CAST(o_custkey AS STRING)) AS PLICNUM
        FROM {{orders}}
        GROUP BY 1, 2, 3""",
    "phone_panel": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month, o_orderkey AS rid,
               CASE o_orderkey % 4 WHEN 0 THEN NULL
                    WHEN 1 THEN '(555) ' || lpad(CAST(o_custkey % 1000 AS STRING), 3, '0') || '-0'
                                || lpad(CAST(o_custkey % 1000 AS STRING), 3, '0')
                    WHEN 2 THEN '555' || lpad(CAST(o_custkey % 1000 AS STRING), 7, '0') || '.0'
                    ELSE '555-' || lpad(CAST(o_custkey % 10000 AS STRING), 7, '0') END AS ploctel
        FROM {{orders}}""",
    "other_ids": f"""
        SELECT DISTINCT o_custkey AS npi, {_PANEL_MONTH} AS month, CAST(1 + o_orderkey % 2 AS INT) AS seq,
               'X' || CAST(o_custkey AS STRING) AS OTHPID
        FROM {{orders}}""",
    "other_id_states": f"""
        SELECT DISTINCT o_custkey AS npi, {_PANEL_MONTH} AS month, CAST(1 + o_orderkey % 3 AS INT) AS seq,
               CASE WHEN o_custkey % 3 = 0 THEN 'IL' ELSE 'WI' END AS OTHPIDST
        FROM {{orders}}""",
    "other_id_types": f"""
        SELECT DISTINCT o_custkey AS npi, {_PANEL_MONTH} AS month, CAST(1 AS INT) AS seq,
               CASE WHEN o_custkey % 6 IN (0, 2) THEN 5 ELSE 1 END AS OTHPIDTY
        FROM {{orders}}""",
    "addresses": f"""
        SELECT o_custkey AS npi, {_PANEL_MONTH} AS month,
               CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'LINE ' || CAST({_LOC_G} AS STRING)
               END AS plocline1,
               CASE WHEN o_orderkey % 3 = 1 THEN 'SUITE' END AS plocline2,
               'CITY ' || CAST({_LOC_G} % 30 AS STRING) AS ploccityname,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE {_state(_LOC_G)} END AS plocstatename,
               CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE {_zip(_LOC_G)} END AS ploczip,
               CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_phone(_LOC_G)} END AS ploctel
        FROM {{orders}}""",
    "waiver_dates": f"""
        SELECT c_custkey * 2 AS npi, CAST(DATE '1997-03-10' + CAST(c_custkey % 400 AS INT)
               * INTERVAL 1 DAY AS DATE) AS Date
        FROM {{customer}}""",
    # ---------------------------------------------------------------- names
    "n_first": """
        SELECT p_partkey AS npi, CASE WHEN p_partkey % 11 = 0 THEN NULL
               ELSE upper(split_part(p_name, ' ', 1)) END AS pfname FROM {part}
        UNION ALL
        SELECT p_partkey, 'AL' || upper(split_part(p_name, ' ', 1)) FROM {part}
        WHERE p_size < 12""",
    "n_middle": """
        SELECT p_partkey AS npi, CASE WHEN p_partkey % 3 = 0 THEN NULL
               WHEN p_partkey % 3 = 1 THEN 'Q.' ELSE upper(p_type) END AS pmname FROM {part}""",
    "n_last": """
        SELECT p_partkey AS npi, CASE WHEN p_partkey % 13 = 0 THEN upper(split_part(p_name, ' ', 2))
                 || ' (MAIDEN ' || upper(p_type) || ')'
               WHEN p_partkey % 17 = 0 THEN upper(split_part(p_name, ' ', 2)) || ';'
               WHEN p_partkey % 19 = 0 THEN upper(split_part(p_name, ' ', 2)) || ', JR'
               ELSE upper(split_part(p_name, ' ', 2)) END AS plname FROM {part}
        UNION ALL
        SELECT p_partkey, upper(split_part(p_name, ' ', 2)) || '+' FROM {part}
        WHERE p_size > 42""",
    "n_suffix": """
        SELECT p_partkey AS npi, CASE WHEN p_partkey % 10 = 0 THEN 'JR'
               WHEN p_partkey % 10 = 5 THEN 'III' END AS pnamesuffix FROM {part}""",
    "o_first": """
        SELECT p_partkey * 4 AS npi, 'EX' || upper(split_part(p_name, ' ', 1)) AS pfnameoth
        FROM {part}""",
    "o_middle": """
        SELECT p_partkey * 3 AS npi, 'Z' AS pmnameoth FROM {part}""",
    "o_last": """
        SELECT p_partkey * 2 AS npi, upper(split_part(p_name, ' ', 2)) AS plnameoth
        FROM {part}""",
    "o_suffix": """
        SELECT p_partkey * 30 AS npi, 'SR' AS pnamesuffixoth FROM {part}""",
    "person_names": """
        SELECT p_partkey AS npi, upper(split_part(p_name, ' ', 1)) AS pfname,
               CASE WHEN p_partkey % 3 = 0 THEN '' WHEN p_partkey % 3 = 1 THEN 'Q.'
                    ELSE upper(p_type) END AS pmname,
               upper(split_part(p_name, ' ', 2)) ||
                 CASE WHEN p_partkey % 20 = 1 THEN ', JR' WHEN p_partkey % 20 = 2 THEN ' III'
                      WHEN p_partkey % 20 = 3 THEN 'JR' WHEN p_partkey % 20 = 4 THEN ',J R'
                      WHEN p_partkey % 20 = 5 THEN ' ST. JAMES' ELSE '' END AS plname,
               CASE WHEN p_partkey % 7 = 0 THEN 'JR' WHEN p_partkey % 7 = 1 THEN 'III' ELSE ''
               END AS pnamesuffix
        FROM {part}""",
    "listed_people": """
        SELECT p_partkey AS samhsa_id,
               upper(split_part(p_name, ' ', 1)) || CASE WHEN p_partkey % 3 = 0 THEN ' '
                    WHEN p_partkey % 3 = 1 THEN ' Q. ' ELSE '  ' || upper(p_type) || ' ' END
               || upper(split_part(p_name, ' ', 2)) || CAST(p_partkey AS STRING)
               || CASE p_partkey % 10 WHEN 0 THEN ' M.D.' WHEN 1 THEN ', M.D., PHD'
                    WHEN 2 THEN ' JR. MD' WHEN 3 THEN ', III, M. D.' WHEN 4 THEN ' NP FNP-BC'
                    WHEN 5 THEN ' D.O.,' WHEN 6 THEN ' SR' ELSE '' END AS NameFull
        FROM {part}""",
    # ------------------------------------------------------------ directory
    "directory": f"""
        SELECT DISTINCT l_partkey AS npi, {_QUARTER} AS date,
               CASE WHEN l_orderkey % 6 = 0 THEN NULL
                    ELSE 'ORG ' || CAST({_DIR_G} AS STRING) END AS org_name,
               CASE WHEN l_orderkey % 4 = 0 OR l_partkey % 13 = 0 THEN NULL
                    ELSE {_DIR_G} END AS group_id,
               CASE WHEN l_linenumber = 1 THEN NULL ELSE 10 + {_DIR_G} % 7 END AS group_size,
               CASE WHEN l_orderkey % 50 = 7 THEN NULL ELSE {_state(_DIR_G)} END AS state,
               CASE WHEN l_orderkey % 60 = 9 THEN NULL ELSE {_zip(_DIR_G)} END AS zip,
               CASE WHEN l_orderkey % 3 = 0 THEN NULL
                    WHEN l_partkey % 5 = 0 AND l_orderkey % 17 = 0 THEN {_phone(_DIR_G, '1')}
                    ELSE {_phone(_DIR_G)} END AS phone
        FROM {{lineitem}}""",
    "raw_directory": f"""
        SELECT DISTINCT l_partkey AS npi, {_QUARTER} AS date, {_DIR_G} AS group_id,
               CASE l_partkey % 4 WHEN 0 THEN 'MA' WHEN 1 THEN 'NY' WHEN 2 THEN 'PR' ELSE 'OH'
               END AS state,
               CASE l_orderkey % 6 WHEN 0 THEN CAST(1001 + {_DIR_G} % 8000 AS STRING)
                    WHEN 1 THEN lpad(CAST({_DIR_G} % 900 + 100 AS STRING), 3, '1')
                    WHEN 2 THEN '00' || lpad(CAST({_DIR_G} % 900 + 100 AS STRING), 3, '1')
                    WHEN 3 THEN CAST(10000001 + {_DIR_G} AS STRING)
                    WHEN 4 THEN '9' || CAST(1001 + {_DIR_G} % 8000 AS STRING)
                    ELSE NULL END AS zip,
               CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '12345'
                    WHEN 2 THEN {_phone(_DIR_G)} || '.0' ELSE {_phone(_DIR_G)} END AS phone
        FROM {{lineitem}}""",
    "directory_people": """
        SELECT DISTINCT l_partkey AS npi,
               CASE l_suppkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'MD'
                    WHEN 3 THEN 'DO' WHEN 4 THEN 'NP' ELSE 'PA' END AS credential,
               CASE WHEN l_suppkey % 11 = 0 THEN 'NURSE PRACTITIONER'
                    WHEN l_suppkey % 2 = 0 THEN 'SPEC ' || CAST(l_suppkey % 7 AS STRING)
                    ELSE 'SPEC ' || CAST(l_suppkey % 3 AS STRING) END AS primary_specialty
        FROM {lineitem}""",
    "schools": """
        SELECT l_partkey AS npi,
               CASE WHEN l_partkey % 3 = 0 THEN 'OTHER' WHEN l_partkey % 3 = 1 AND l_suppkey % 2 = 0
                    THEN NULL WHEN l_partkey % 3 = 1 OR l_orderkey % 2 = 0 THEN 'OTHER'
                    ELSE 'SCHOOL ' || CAST(l_suppkey % 9 AS STRING) END AS medical_school,
               CASE WHEN l_partkey % 3 = 0 AND l_partkey % 2 = 0 THEN 1980
                    WHEN l_partkey % 3 = 0 OR l_orderkey % 7 = 0 THEN NULL
                    ELSE 1960 + l_suppkey % 50 END AS graduation_year
        FROM {lineitem}""",
    "specialty_rows": """
        SELECT DISTINCT l_partkey AS npi, CAST(date_trunc('year', l_shipdate) AS DATE) AS date,
               'SPEC ' || CAST(l_suppkey % 7 AS STRING) AS primary_specialty,
               CASE WHEN l_orderkey % 3 = 0 THEN 'SUB 1' END AS secondary_specialty_1,
               CASE WHEN l_orderkey % 4 = 0 THEN 'SUB 2' ELSE ' ' END AS secondary_specialty_2,
               CASE WHEN l_orderkey % 5 = 0 THEN 'PREVENTATIVE MEDICINE' END
                   AS secondary_specialty_3,
               CAST(NULL AS STRING) AS secondary_specialty_4
        FROM {lineitem}""",
    # --------------------------------------------------------------- panels
    "locations": f"""
        SELECT DISTINCT o_custkey AS npi, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter,
               CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE {_state(_LOC_G)} END AS plocstatename,
               {_zip(_LOC_G)} AS ploczip,
               CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE {_phone(_LOC_G)} END AS ploctel
        FROM {{orders}}""",
    "types": """
        SELECT c_custkey + 5 AS npi,
               CASE WHEN c_custkey % 3 IN (0, 2) THEN 1 ELSE 0 END AS md_do,
               CASE WHEN c_custkey % 3 IN (1, 2) THEN 1 ELSE 0 END AS NP,
               CASE c_custkey % 3 WHEN 0 THEN 'MD/DO' WHEN 1 THEN 'NP' ELSE 'both' END AS cat
        FROM {customer}""",
    "registry_types": """
        SELECT c_custkey AS npi, CASE WHEN c_custkey % 4 IN (0, 2) THEN 1 ELSE 0 END AS md_do,
               CASE WHEN c_custkey % 4 IN (1, 2) THEN 1 ELSE 0 END AS NP
        FROM {customer}""",
    "type_creds": """
        SELECT c_custkey AS npi, 'MD/DO' AS cat FROM {customer}
        WHERE c_custkey % 4 IN (0, 2) AND c_custkey % 5 IN (0, 1)
        UNION ALL
        SELECT c_custkey AS npi, 'NP' AS cat FROM {customer}
        WHERE c_custkey % 4 IN (1, 2) AND c_custkey % 5 IN (1, 2)""",
    "type_listed": """
        SELECT DISTINCT l_partkey AS npi,
               CASE WHEN l_partkey % 6 IN (0, 1) THEN 'MD' WHEN l_partkey % 6 = 2 THEN 'NP' END
                   AS credential,
               CASE WHEN l_partkey % 10 = 0 THEN 'NURSE PRACTITIONER' ELSE 'SPEC' END
                   AS primary_specialty
        FROM {lineitem}""",
    "group_rows": f"""
        SELECT DISTINCT o_custkey AS npi, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter,
               CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE {_state(_LOC_G)} END AS state,
               {_zip(_LOC_G)} AS zip,
               CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE {_LOC_G} END AS group_id,
               {_LOC_G} + 100000000000 AS my_group_id,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE {_LOC_G} + 300000000000 END
                   AS my_group_id_npi
        FROM {{orders}}""",
    "urban": """
        SELECT lpad(CAST(p_partkey * 3 AS STRING), 5, '1') AS ZCTA5,
               CAST(1 + p_partkey % 6 AS INT) AS NCHSUR2013
        FROM {part} WHERE p_size < 20
        UNION ALL
        SELECT lpad(CAST(p_partkey * 3 + 1 AS STRING), 5, '1'),
               CAST(1 + (p_partkey + 1) % 6 AS INT)
        FROM {part} WHERE p_size < 20""",
    "members": f"""
        SELECT DISTINCT l_partkey AS npi, {_QUARTER} AS quarter,
               CAST({_DIR_G} AS STRING) AS group_quarter_loc_id,
               CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE 0 END AS md_do,
               CASE WHEN l_partkey % 3 > 0 OR l_partkey % 15 = 0 THEN 1 ELSE 0 END AS NP
        FROM {{lineitem}}""",
    # --------------------------------------------------------------- claims
    "claims_detail": """
        SELECT l_suppkey AS npi, CAST(year(l_shipdate) AS INT) AS Year, l_partkey AS drug_name,
               l_returnflag AS generic_name,
               CAST(sum(l_quantity) AS BIGINT) AS total_claim_count
        FROM {lineitem} GROUP BY 1, 2, 3, 4""",
    "claims_shown": """
        SELECT * FROM {claims_detail} WHERE total_claim_count >= 11""",
    "claims_summary": """
        SELECT l_suppkey + 3 AS npi, CAST(year(l_shipdate) AS INT) AS Year,
               CAST(sum(l_quantity) AS BIGINT) AS total_claim_count,
               CASE WHEN count(CASE WHEN l_orderkey % 40 = 0 THEN 1 END) BETWEEN 1 AND 10 THEN NULL
                    ELSE count(CASE WHEN l_orderkey % 40 = 0 THEN 1 END) END AS opioid_claim_count
        FROM {lineitem} GROUP BY 1, 2""",
    "services": """
        SELECT o_custkey AS npi, CAST(year(o_orderdate) AS INT) AS Year, l_returnflag AS hcpcs_code,
               l_linestatus AS place_of_service,
               CASE WHEN count(*) % 5 = 0 THEN NULL ELSE count(*) END AS beneficiaries
        FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey GROUP BY 1, 2, 3, 4""",
    # -------------------------------------------------------------- linkage
    "linked": """
        SELECT p_partkey AS k, CAST(floor(p_partkey / 2) AS BIGINT) AS m, p_partkey % 2 AS side,
               p_type, p_size FROM {part}""",
    "link_names": """
        SELECT k, m, side,
               CASE m % 2 WHEN 0 THEN 'JOHN' ELSE 'MARY' END AS f,
               CASE WHEN m % 5 = 0 THEN '' ELSE 'ANN' END AS mid,
               CASE m % 3 WHEN 0 THEN 'SMITH' WHEN 1 THEN 'O''HARA' ELSE 'LEE' END
                 || CAST(CAST(floor(m / 8) AS BIGINT) AS STRING)
                 || CASE WHEN side = 1 AND m % 16 = 3 THEN '-X' WHEN m % 16 = 3 THEN 'X'
                    ELSE '' END AS l
        FROM {linked}""",
    "link_list": """
        SELECT k AS samhsa_id, f || ' ' || CASE WHEN mid = '' THEN '' ELSE mid || ' ' END || l
               AS name, mid AS middlename, '' AS Suffix, 1 AS ord
        FROM {link_names} WHERE side = 1
        UNION ALL
        SELECT k, f || ' ' || l, '', '', 2 FROM {link_names} WHERE side = 1 AND mid <> ''""",
    "link_target": """
        SELECT k AS npi, f || ' ' || CASE WHEN mid = '' OR m % 9 = 0 THEN '' ELSE mid || ' ' END || l
               AS name, '' AS Suffix
        FROM {link_names} WHERE side = 0
        UNION ALL
        SELECT k, f || ' ' || l, '' FROM {link_names} WHERE side = 0 AND m % 4 = 0""",
    "link_attr": """
        SELECT k, side,
               CASE WHEN m % 11 = 0 AND side = 1 THEN 'NP' ELSE 'MD/DO' END AS practitioner_type,
               CASE WHEN m % 13 = 0 THEN NULL WHEN m % 7 = 0 AND side = 1 THEN 'ZZ'
                    ELSE 'S' || CAST(m % 40 AS STRING) END AS state,
               CASE WHEN m % 6 = 0 AND side = 0 THEN '99999'
                    ELSE lpad(CAST(m % 80000 AS STRING), 5, '1') END AS zip5,
               CASE WHEN m % 5 = 0 THEN NULL WHEN m % 3 = 0 AND side = 0 THEN '5550000000'
                    ELSE lpad(CAST(m AS STRING), 10, '5') END AS tel
        FROM {linked}""",
    "deaths": """
        SELECT s_suppkey AS case_id,
               CASE s_suppkey % 2 WHEN 0 THEN 'John ' ELSE 'mary' END AS first,
               CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'a.' WHEN 2 THEN 'Ann' ELSE 'Beth'
               END AS middle,
               CASE s_suppkey % 3 WHEN 0 THEN 'Smith' WHEN 1 THEN 'Lee' ELSE 'Roe' END
                 || CAST(CAST(floor(s_suppkey / 3) AS BIGINT) AS STRING) AS last,
               CAST(DATE '2000-01-01' + CAST(s_suppkey % 300 AS INT) * INTERVAL 1 DAY AS DATE)
                   AS death_date,
               CASE WHEN s_suppkey % 5 = 0 THEN 'IL' ELSE 'FL' END AS death_state
        FROM {supplier}""",
    "death_names": """
        SELECT c_custkey AS npi, CASE c_custkey % 2 WHEN 0 THEN 'JOHN' ELSE 'MARY' END AS pfname,
               CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'A' WHEN 2 THEN 'ANN' WHEN 3 THEN 'B'
                    ELSE 'BETH' END AS pmname,
               CASE c_custkey % 3 WHEN 0 THEN 'SMITH' WHEN 1 THEN 'LEE' ELSE 'ROE' END
                 || CAST(CAST(floor(c_custkey / 30) AS BIGINT) AS STRING) AS plname
        FROM {customer}""",
    "death_removed": """
        SELECT c_custkey * 2 AS npi,
               CAST(DATE '2000-03-01' + CAST(c_custkey % 250 AS INT) * INTERVAL 1 DAY AS DATE)
                   AS npideactdate
        FROM {customer}""",
    "death_states": """
        SELECT c_custkey AS npi, CASE WHEN c_custkey % 3 = 0 THEN 'IL' ELSE 'FL' END AS plocstatename
        FROM {customer}""",
    "waivers": """
        SELECT o_orderkey AS samhsa_id,
               CAST(CASE o_orderkey % 3 WHEN 0 THEN 30 WHEN 1 THEN 100 ELSE 275 END AS INT)
                   AS WaiverType,
               CAST(o_orderdate AS DATE) AS Date, 'S' || CAST(o_custkey % 4 AS STRING) AS State
        FROM {orders}""",
    "crosswalk": """
        SELECT o_orderkey * 2 AS samhsa_id, o_custkey AS npi FROM {orders}""",
    "licence_rows": """
        SELECT o_orderkey AS rid,
               'person ' || CAST(o_custkey AS STRING) AS NameFull,
               CASE WHEN o_orderkey % 3 = 0 THEN 'md' ELSE 'np' END AS PractitionerType,
               CAST(CAST(DATE '1960-01-01' + CAST(12800 + o_orderkey % 2400 AS INT)
                    * INTERVAL 1 DAY AS DATE) AS STRING) AS DateLastCertified,
               CASE WHEN o_orderkey % 4 = 0 THEN
                    CAST(CAST(DATE '1960-01-01' + CAST(12800 + o_orderkey % 2400 AS INT)
                    * INTERVAL 1 DAY AS DATE) AS STRING) END AS DateGranted,
               CAST(12800 + o_orderkey % 2400 AS BIGINT) AS Date
        FROM {orders}""",
}
