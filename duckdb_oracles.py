"""The same queries in DuckDB SQL, for the side-by-side check.

Each oracle is one statement: the CTEs it needs, in order, then its final SELECT.
"""

from __future__ import annotations

# --- the feeds, as views over the order tables ----------------------------------------


def _messy(text: str) -> str:
    return (
        f"CASE WHEN k % 33 = 0 THEN upper({text}) WHEN k % 33 = 1 THEN '  ' || {text} || ' ' "
        f"WHEN k % 50 = 2 THEN lower({text}) ELSE {text} END"
    )


def _label(c: str) -> str:
    words = f"string_split(regexp_replace(lower(trim({c})), '[ \\t\\n\\f\\r]+', ' ', 'g'), ' ')"
    return (
        f"nullif(array_to_string([array_to_string([upper(p[1]) || p[2:] FOR p IN string_split(w, '-')], '-') "
        f"FOR w IN {words}], ' '), '')"
    )


def _age(c: str) -> str:
    number = f"try_cast(regexp_extract(trim({c}), '^(-?[0-9]+)', 1) AS INTEGER)"
    unit = (
        f"CASE WHEN contains(lower({c}), 'year') THEN 365 WHEN contains(lower({c}), 'month') THEN 30 "
        f"WHEN contains(lower({c}), 'week') THEN 7 WHEN contains(lower({c}), 'day') THEN 1 END"
    )
    return f"CASE WHEN {number} >= 0 THEN {number} * ({unit}) END"


def _key(*cols: str) -> str:
    return "md5(" + " || '|-|' || ".join(f"coalesce(cast({c} AS VARCHAR), '_dbt_null_')" for c in cols) + ")"


def _class(c: str) -> str:
    return (
        f"CASE WHEN {c} IN ('Adoption', 'Return To Owner', 'Rto-Adopt', 'Transfer') THEN 'Live' "
        f"WHEN {c} IN ('Euthanasia', 'Died', 'Disposal', 'Missing') THEN 'Non-Live' "
        f"WHEN {c} IS NOT NULL THEN 'Unknown' END"
    )


def _pct(top: str, bottom: str) -> str:
    return f"round(100.0 * {top} / nullif({bottom}, 0), 2)"


_NAME = "CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE 'Name' || (k % 50) END"
_TYPE = (
    "CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'BUILDING') THEN 'Dog' "
    "WHEN c_mktsegment IN ('FURNITURE', 'AUTOMOBILE') THEN 'Cat' WHEN c_mktsegment = 'MACHINERY' THEN 'Other' END"
)
_SEX = (
    "CASE k % 5 WHEN 0 THEN 'Neutered Male' WHEN 1 THEN 'Spayed Female' WHEN 2 THEN 'Intact Male' "
    "WHEN 3 THEN 'Intact Female' ELSE 'Unknown' END"
)
_AGE_TEXT = (
    "CASE WHEN k % 60 = 0 THEN 'NULL' WHEN k % 60 = 1 THEN '-2 years' WHEN k % 60 = 2 THEN NULL "
    "WHEN k % 60 = 3 THEN 'unknown' WHEN k % 60 < 20 THEN (k % 12) || ' months' "
    "WHEN k % 60 < 30 THEN (k % 4 + 1) || ' weeks' WHEN k % 60 < 33 THEN (k % 6 + 1) || ' days' "
    "ELSE (k % 14 + 1) || ' years' END"
)
_BREED = (
    "CASE k % 3 WHEN 0 THEN 'Breed ' || (k % 60) || ' Mix' "
    "WHEN 1 THEN 'Breed ' || (k % 60) || '/Breed ' || (k % 7) ELSE 'Breed ' || (k % 60) END"
)
_COLOR = "CASE k % 4 WHEN 0 THEN 'Black/White' WHEN 1 THEN 'Tan' WHEN 2 THEN 'Brown Tabby' ELSE 'White' END"
_PLACE = (
    "CASE k % 4 WHEN 0 THEN 'City' || (k % 9) || ' (TX)' "
    "WHEN 1 THEN (k % 900) || ' Main St in City' || (k % 9) || ' (TX)' WHEN 2 THEN 'Outside Jurisdiction' END"
)
_INTAKE = (
    "(CASE o_orderpriority WHEN '1-URGENT' THEN 'Stray' WHEN '2-HIGH' THEN 'Owner Surrender' "
    "WHEN '3-MEDIUM' THEN 'Public Assist' "
    "WHEN '4-NOT SPECIFIED' THEN CASE WHEN k % 2 = 0 THEN 'Wildlife' ELSE 'Abandoned' END "
    "WHEN '5-LOW' THEN CASE WHEN k % 3 = 0 THEN 'Euthanasia Request' ELSE 'Stray' END END)"
)
_CONDITION = "(CASE o_orderstatus WHEN 'F' THEN 'Normal' WHEN 'O' THEN 'Injured' WHEN 'P' THEN 'Sick' END)"
_OUTCOME = (
    "(CASE WHEN k % 97 = 5 THEN 'Relocate' WHEN k % 101 = 6 THEN NULL WHEN k % 11 = 3 THEN 'Missing' "
    "ELSE CASE rf WHEN 'AF' THEN 'Adoption' WHEN 'AO' THEN 'Transfer' WHEN 'NF' THEN 'Return to Owner' "
    "WHEN 'NO' THEN 'Rto-Adopt' WHEN 'RF' THEN 'Euthanasia' WHEN 'RO' THEN 'Died' END END)"
)

_CTES: dict[str, str] = {}

_CTES["base"] = """
  SELECT o_orderkey AS k, 'A' || o_custkey AS animal_id, c_mktsegment, o_orderpriority, o_orderstatus,
         o_orderdate + to_minutes(o_orderkey % 1440) AS ts
  FROM orders JOIN customer ON c_custkey = o_custkey"""
_CTES["goods"] = """
  SELECT l_orderkey AS k, cast(min(l_quantity) AS INTEGER) AS q, min(l_returnflag || l_linestatus) AS rf
  FROM lineitem GROUP BY l_orderkey"""
_CTES["start_once"] = f"""
  SELECT k, animal_id, {_NAME} AS name,
         CASE WHEN k % 120 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.000') END AS datetime,
         {_PLACE} AS found_location, {_messy(_INTAKE)} AS intake_type,
         {_messy(_CONDITION)} AS intake_condition, {_TYPE} AS animal_type, {_SEX} AS sex_upon_intake,
         {_AGE_TEXT} AS age_upon_intake, {_BREED} AS breed, {_COLOR} AS color
  FROM base"""
_CTES["raw_starts"] = """
  SELECT * EXCLUDE (k) FROM start_once
  UNION ALL SELECT * EXCLUDE (k) FROM start_once WHERE k % 181 = 0"""
_CTES["timed_ends"] = """
  SELECT base.*, rf, CASE WHEN k % 250 = 7 THEN ts - to_days(3)
         ELSE ts + to_days(q) + to_minutes((k * 7) % 600) END AS end_at
  FROM base JOIN goods USING (k)"""
_CTES["end_once"] = f"""
  SELECT k, animal_id, {_NAME} AS name, strftime(end_at, '%Y-%m-%dT%H:%M:%S.000') AS datetime,
         CASE WHEN k % 77 = 0 THEN 'not a date' WHEN k % 77 = 1 THEN '2024' WHEN k % 77 = 2 THEN '2024-03'
              WHEN k % 77 = 3 THEN '2024-03-05 14' ELSE strftime(ts - to_days(cast(k % 4000 AS INTEGER)), '%Y-%m-%dT00:00:00.000') END AS date_of_birth,
         {_messy(_OUTCOME)} AS outcome_type,
         CASE WHEN {_OUTCOME} = 'Transfer' AND {_TYPE} = 'Cat' AND k % 2 = 0 THEN 'SNR'
              WHEN {_OUTCOME} = 'Transfer' THEN 'Partner' END AS outcome_subtype,
         {_TYPE} AS animal_type, {_SEX} AS sex_upon_outcome, {_AGE_TEXT} AS age_upon_outcome,
         {_BREED} AS breed, {_COLOR} AS color
  FROM timed_ends WHERE end_at < (SELECT cast(max(o_orderdate) AS DATE) + INTERVAL 1 DAY FROM orders)"""
_CTES["raw_ends"] = """
  SELECT * EXCLUDE (k) FROM end_once
  UNION ALL SELECT * EXCLUDE (k) FROM end_once WHERE k % 181 = 0"""

# --- staging and episodes -------------------------------------------------------------

_CTES["typed_starts"] = f"""
  SELECT animal_id, cast(datetime AS TIMESTAMP) AS intake_at, nullif(trim(name), '') AS animal_name,
         nullif(trim(found_location), '') AS found_location, {_label('intake_type')} AS intake_type,
         {_label('intake_condition')} AS intake_condition, {_label('animal_type')} AS animal_type,
         {_label('sex_upon_intake')} AS sex_upon_intake, {_age('age_upon_intake')} AS age_at_intake_days,
         nullif(trim(breed), '') AS breed, nullif(trim(color), '') AS color
  FROM (SELECT DISTINCT * FROM raw_starts WHERE animal_id IS NOT NULL AND datetime IS NOT NULL)"""
_CTES["starts"] = f"""
  SELECT {_key('animal_id', 'stay_sequence')} AS stay_key, *
  FROM (SELECT *, row_number() OVER (PARTITION BY animal_id ORDER BY intake_at,
               animal_name NULLS FIRST, found_location NULLS FIRST, intake_type NULLS FIRST,
               intake_condition NULLS FIRST, animal_type NULLS FIRST, sex_upon_intake NULLS FIRST,
               age_at_intake_days NULLS FIRST, breed NULLS FIRST, color NULLS FIRST) AS stay_sequence
        FROM typed_starts)"""
_CTES["typed_ends"] = f"""
  SELECT animal_id, cast(datetime AS TIMESTAMP) AS outcome_at, try_cast(date_of_birth AS TIMESTAMP) AS date_of_birth,
         nullif(trim(name), '') AS animal_name, {_label('outcome_type')} AS outcome_type,
         {_label('outcome_subtype')} AS outcome_subtype, {_label('animal_type')} AS animal_type,
         {_label('sex_upon_outcome')} AS sex_upon_outcome, {_age('age_upon_outcome')} AS age_at_outcome_days,
         nullif(trim(breed), '') AS breed, nullif(trim(color), '') AS color
  FROM (SELECT DISTINCT * FROM raw_ends WHERE animal_id IS NOT NULL AND datetime IS NOT NULL)"""
_CTES["ends"] = f"""
  SELECT {_key('animal_id', 'stay_sequence')} AS stay_key, *
  FROM (SELECT *, row_number() OVER (PARTITION BY animal_id ORDER BY outcome_at,
               date_of_birth NULLS FIRST, animal_name NULLS FIRST, outcome_type NULLS FIRST,
               outcome_subtype NULLS FIRST, animal_type NULLS FIRST, sex_upon_outcome NULLS FIRST,
               age_at_outcome_days NULLS FIRST, breed NULLS FIRST, color NULLS FIRST) AS stay_sequence
        FROM typed_ends)"""
_CTES["episodes"] = f"""
  SELECT s.stay_key, s.animal_id, s.stay_sequence, s.intake_at, e.outcome_at, s.intake_type,
         s.intake_condition, e.outcome_type, e.outcome_subtype, coalesce(s.animal_type, e.animal_type) AS animal_type,
         coalesce(s.animal_name, e.animal_name) AS animal_name, coalesce(s.breed, e.breed) AS breed,
         coalesce(s.color, e.color) AS color, s.sex_upon_intake, e.sex_upon_outcome, s.found_location,
         e.date_of_birth, s.age_at_intake_days, e.age_at_outcome_days, e.outcome_at IS NULL AS is_open_stay,
         coalesce(e.outcome_at < s.intake_at, false) AS has_invalid_duration,
         CASE WHEN e.outcome_at >= s.intake_at THEN date_diff('day', s.intake_at, e.outcome_at) END AS length_of_stay_days,
         {_class('e.outcome_type')} AS outcome_class,
         s.intake_type = 'Euthanasia Request' AS is_owner_requested_euthanasia
  FROM starts s LEFT JOIN ends e USING (animal_id, stay_sequence)"""

# --- marts ----------------------------------------------------------------------------

_CTES["fact"] = """
  SELECT stay_key, animal_id, stay_sequence, stay_sequence > 1 AS is_return_stay, intake_at,
         cast(intake_at AS DATE) AS intake_date, cast(date_trunc('month', intake_at) AS TIMESTAMP) AS intake_month,
         outcome_at, cast(outcome_at AS DATE) AS outcome_date,
         cast(date_trunc('month', outcome_at) AS TIMESTAMP) AS outcome_month, is_open_stay, length_of_stay_days,
         intake_type, intake_condition, outcome_type, outcome_subtype, outcome_class,
         is_owner_requested_euthanasia, animal_type, animal_name, animal_name IS NOT NULL AS was_named, breed,
         color, sex_upon_intake, sex_upon_outcome, found_location, age_at_intake_days,
         CASE WHEN age_at_intake_days >= 2555 THEN '7 years and over'
              WHEN age_at_intake_days >= 1095 THEN '3 to 7 years'
              WHEN age_at_intake_days >= 365 THEN '1 to 3 years'
              WHEN age_at_intake_days >= 180 THEN '6 to 12 months'
              WHEN age_at_intake_days IS NOT NULL THEN 'Under 6 months' END AS age_band_at_intake
  FROM episodes WHERE NOT has_invalid_duration"""
_CTES["dimension"] = """
  SELECT animal_id, animal_name, animal_type, breed, color, sex_upon_outcome AS sex_latest, stay_count,
         stay_count > 1 AS has_returned, first_intake_at, last_intake_at, last_outcome_at, is_currently_in_care,
         total_days_in_care
  FROM (SELECT animal_id, count(*) AS stay_count, min(intake_at) AS first_intake_at,
               max(intake_at) AS last_intake_at, max(outcome_at) AS last_outcome_at,
               bool_or(is_open_stay) AS is_currently_in_care,
               cast(sum(length_of_stay_days) AS BIGINT) AS total_days_in_care
        FROM fact GROUP BY animal_id)
  JOIN (SELECT animal_id, animal_name, animal_type, breed, color, sex_upon_outcome FROM fact
        QUALIFY row_number() OVER (PARTITION BY animal_id ORDER BY intake_at DESC, stay_sequence DESC) = 1)
  USING (animal_id)"""
_CTES["mart"] = f"""
  SELECT outcome_month, animal_type, count(*) AS outcomes_total,
         count_if(outcome_class = 'Live') AS outcomes_live, count_if(outcome_class = 'Non-Live') AS outcomes_non_live,
         count_if(outcome_class = 'Unknown') AS outcomes_unclassified,
         count_if(outcome_type = 'Adoption') AS outcomes_adoption,
         count_if(outcome_type = 'Transfer') AS outcomes_transfer,
         count_if(outcome_type = 'Return To Owner') AS outcomes_return_to_owner,
         count_if(outcome_type = 'Euthanasia') AS outcomes_euthanasia,
         count_if(is_return_stay) AS outcomes_return_stays,
         {_pct("count_if(outcome_class = 'Live')", "count_if(outcome_class IN ('Live', 'Non-Live'))")}
           AS live_release_rate_pct,
         {_pct("count_if(outcome_class = 'Live' AND NOT is_owner_requested_euthanasia)",
               "count_if(outcome_class IN ('Live', 'Non-Live') AND NOT is_owner_requested_euthanasia)")}
           AS live_release_rate_adjusted_pct,
         round(avg(length_of_stay_days), 1) AS avg_length_of_stay_days,
         cast(median(length_of_stay_days) AS DOUBLE) AS median_length_of_stay_days,
         cast(quantile_cont(length_of_stay_days, 0.9) AS DOUBLE) AS p90_length_of_stay_days
  FROM fact WHERE NOT is_open_stay GROUP BY outcome_month, animal_type"""
_CTES["issues"] = """
  SELECT stay_key, animal_id, 'outcome_before_intake' AS issue_type,
         'Outcome timestamp precedes intake timestamp. Indicates a missing record in the animal''s history shifting the intake-to-outcome pairing, or a source data entry error.' AS issue_description,
         intake_at, outcome_at FROM episodes WHERE has_invalid_duration
  UNION ALL SELECT stay_key, animal_id, 'unrecognised_outcome_type',
         'Outcome type is not in the known live or non-live sets, so the stay is absent from live release rate calculations.',
         intake_at, outcome_at FROM episodes WHERE outcome_class = 'Unknown'
  UNION ALL SELECT stay_key, animal_id, 'unusable_age_at_intake',
         'Age on intake was absent, non-numeric, or negative, so no age band could be assigned.',
         intake_at, outcome_at FROM episodes WHERE age_at_intake_days IS NULL
  UNION ALL SELECT stay_key, animal_id, 'outcome_without_intake',
         'Outcome has no matching intake at the same stay sequence, so the stay is absent from fct_shelter_stays entirely. Usually an animal whose intake predates the published data range.',
         NULL, outcome_at FROM ends ANTI JOIN starts USING (stay_key)"""


# --- features, labels, windows ----------------------------------------------------------

_CTES["census"] = """
  SELECT animal_type, event_date, net_change,
         coalesce(cast(sum(net_change) OVER (PARTITION BY animal_type ORDER BY event_date
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS census_morning
  FROM (SELECT animal_type, event_date, cast(sum(delta) AS BIGINT) AS net_change
        FROM (SELECT animal_type, intake_date AS event_date, 1 AS delta FROM fact
              UNION ALL SELECT animal_type, outcome_date, -1 FROM fact WHERE outcome_date IS NOT NULL)
        GROUP BY animal_type, event_date)"""
_CTES["frame"] = """
  SELECT stay_key, animal_id, stay_sequence, intake_at, outcome_at, is_open_stay, length_of_stay_days,
         fact.animal_type, intake_type, intake_condition, sex_upon_intake, outcome_subtype, breed, color,
         found_location, age_at_intake_days, census_morning AS census_same_type
  FROM fact LEFT JOIN census ON census.animal_type = fact.animal_type AND event_date = intake_date"""
_CTES["horizon"] = """
  SELECT as_of, cast(cast(as_of - INTERVAL 30 DAY AS DATE) AS TIMESTAMP) AS label_cutoff, feed_start
  FROM (SELECT greatest(max(intake_at), max(outcome_at)) AS as_of, min(intake_at) AS feed_start FROM fact)"""
_CTES["whole_years"] = """
  SELECT year(feed_start) + cast((month(feed_start), day(feed_start)) <> (1, 1) AS INTEGER) AS first_year,
         year(as_of) - cast((month(as_of), day(as_of)) <> (12, 31) AS INTEGER) AS last_year FROM horizon"""
_CTES["eligible"] = """
  SELECT frame.*, intake_at < label_cutoff AS mature, intake_at >= feed_start + INTERVAL 180 DAY AS warmed_up,
         is_open_stay AND intake_at < as_of - INTERVAL 365 DAY AS implausible, as_of
  FROM frame, horizon
  WHERE animal_type IN ('Dog', 'Cat') AND (intake_type IS NULL OR intake_type NOT IN ('Euthanasia Request', 'Wildlife'))"""
_CTES["labelled"] = """
  SELECT *, cast(is_open_stay OR length_of_stay_days >= 30 AS INTEGER) AS is_long_stay
  FROM eligible WHERE mature AND warmed_up AND NOT implausible"""
_CTES["features"] = """
  SELECT stay_key, intake_at, is_long_stay, coalesce(animal_type, 'Unknown') AS animal_type,
         coalesce(intake_type, 'Unknown') AS intake_type, coalesce(intake_condition, 'Unknown') AS intake_condition,
         CASE WHEN contains(sex_upon_intake, 'Intact') THEN 'Intact'
              WHEN regexp_matches(sex_upon_intake, 'Neutered|Spayed') THEN 'Altered' ELSE 'Unknown' END
           AS reproductive_status,
         CASE WHEN regexp_matches(breed, 'Mix|/') THEN 'Mix' ELSE 'Single' END AS is_mix,
         coalesce(nullif(trim(replace(string_split(breed, '/')[1], ' Mix', '')), ''), 'Unknown') AS primary_breed,
         coalesce(nullif(trim(replace(string_split(color, '/')[1], ' Mix', '')), ''), 'Unknown') AS primary_color,
         CASE WHEN contains(found_location, 'Outside Jurisdiction') THEN 'Outside Jurisdiction'
              ELSE coalesce(nullif(trim(string_split(string_split(found_location, ' in ')[-1], '(')[1]), ''), 'Unknown') END
           AS jurisdiction,
         cast(month(intake_at) AS VARCHAR) AS intake_month, dayname(intake_at) AS intake_weekday,
         cast(age_at_intake_days AS DOUBLE) AS age_at_intake_days,
         cast(least(stay_sequence, 3) AS DOUBLE) AS stay_sequence, cast(census_same_type AS DOUBLE) AS census_same_type
  FROM labelled"""
_CTES["holdout"] = """
  SELECT train_end - INTERVAL 4 YEAR - INTERVAL 0 DAY AS train_start, train_end - INTERVAL 6 MONTH AS calibration_start,
         train_end, score_start, score_end
  FROM (SELECT score_start - INTERVAL 30 DAY AS train_end, score_start, score_end
        FROM (SELECT label_cutoff - INTERVAL 365 DAY AS score_start, label_cutoff AS score_end FROM horizon))"""
_CTES["months"] = """
  SELECT train_end - INTERVAL 4 YEAR AS train_start, train_end - INTERVAL 6 MONTH AS calibration_start, train_end,
         score_start, score_start + INTERVAL 1 MONTH AS score_end
  FROM (SELECT score_start, score_start - INTERVAL 30 DAY AS train_end
        FROM (SELECT cast(date_trunc('month', label_cutoff) AS TIMESTAMP) - to_months(cast(i AS INTEGER)) AS score_start
              FROM horizon, range(1, 13) t(i)))"""

# --- metrics on the pseudo-score -------------------------------------------------------

_CTES["scored"] = """
  SELECT stay_key, is_long_stay AS y, cast('0x' || substr(stay_key, 1, 3) AS BIGINT) / 4096.0::DOUBLE AS p,
         outcome_subtype FROM labelled, holdout WHERE intake_at >= score_start AND intake_at < score_end"""
_CTES["slices"] = """
  SELECT 'all' AS slice, stay_key, y, p FROM scored
  UNION ALL SELECT 'excluding_snr', stay_key, y, p FROM scored WHERE coalesce(outcome_subtype, '') <> 'Snr'"""
_CTES["month_scores"] = """
  SELECT score_start AS slice, stay_key, is_long_stay AS y,
         cast('0x' || substr(stay_key, 1, 3) AS BIGINT) / 4096.0::DOUBLE AS p
  FROM labelled JOIN months ON intake_at >= score_start AND intake_at < score_end"""
_CTES["whole_holdout"] = "SELECT 'holdout' AS slice, stay_key, y, p FROM scored"


def _metrics(source: str) -> str:
    return f"""
  SELECT slice, n, positives / n AS base_rate, mean_predicted,
         CASE WHEN positives > 0 AND positives < n THEN
           (rank_sum - positives * (positives + 1) / 2) / (positives * (n - positives)) END AS roc_auc,
         CASE WHEN positives > 0 THEN average_precision END AS average_precision, brier,
         top_positives / top_n AS top_decile_precision,
         CASE WHEN positives > 0 THEN (top_positives / top_n) / (positives / n) END AS top_decile_lift
  FROM (SELECT slice, count(*) AS n, cast(sum(y) AS DOUBLE) AS positives, avg(p) AS mean_predicted,
               avg((p - y) * (p - y)) AS brier, sum(mean_rank * y) AS rank_sum,
               sum(y * positives_from / rows_from) / nullif(sum(y), 0) AS average_precision,
               cast(sum(y) FILTER (place > n_rows - top_n) AS DOUBLE) AS top_positives, max(top_n) AS top_n
        FROM (SELECT *, greatest(1, cast(round_even(n_rows * 0.1::DOUBLE, 0) AS BIGINT)) AS top_n
              FROM (SELECT slice, y, p, count(*) OVER (PARTITION BY slice) AS n_rows,
                           row_number() OVER (PARTITION BY slice ORDER BY p, stay_key) AS place,
                           rank() OVER (PARTITION BY slice ORDER BY p)
                             + (count(*) OVER (PARTITION BY slice, p) - 1) / 2 AS mean_rank,
                           cast(sum(y) OVER (PARTITION BY slice ORDER BY p DESC
                                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS positives_from,
                           count(*) OVER (PARTITION BY slice ORDER BY p DESC
                                RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rows_from
                    FROM {source}))
        GROUP BY slice)"""


_CTES["holdout_metrics"] = _metrics("whole_holdout")
_CTES["slice_metrics"] = _metrics("slices")
_CTES["month_metrics"] = _metrics("month_scores")
_CTES["places"] = """
  SELECT *, row_number() OVER (ORDER BY p, stay_key) AS position, count(*) OVER () AS n FROM whole_holdout"""

# --- drift ------------------------------------------------------------------------------

_CTES["members"] = """
  SELECT features.*, score_start AS backtest_month, intake_at >= score_start AND intake_at < score_end AS actual,
         intake_at >= train_start AND intake_at < train_end AS expected
  FROM features JOIN months ON month(features.intake_at) = month(score_start)
    AND ((intake_at >= score_start AND intake_at < score_end) OR (intake_at >= train_start AND intake_at < train_end))"""
_CTES["edges"] = """
  SELECT backtest_month, animal_type, list_sort(list_distinct(quantile_cont(census_same_type, [0.2, 0.4, 0.6, 0.8]))) AS edges
  FROM members WHERE expected AND census_same_type IS NOT NULL GROUP BY backtest_month, animal_type"""
_CTES["view_rows"] = """
  SELECT backtest_month, expected, actual, intake_type, intake_condition, animal_type,
         CASE WHEN age_at_intake_days IS NULL OR age_at_intake_days <= -1 THEN 'nan' WHEN age_at_intake_days <= 180 THEN '<6m'
              WHEN age_at_intake_days <= 365 THEN '6-12m' WHEN age_at_intake_days <= 1095 THEN '1-3y'
              WHEN age_at_intake_days <= 2555 THEN '3-7y' ELSE '7y+' END AS age_band,
         CASE WHEN edges IS NULL THEN 'unknown'
              ELSE cast(len([e FOR e IN edges IF e <= coalesce(census_same_type, -1)]) AS VARCHAR) END AS census_band
  FROM members LEFT JOIN edges USING (backtest_month, animal_type)"""
_CTES["shifts"] = """
  SELECT backtest_month AS intake_month, feature, category, count_if(expected) AS expected, count_if(actual) AS actual
  FROM (UNPIVOT view_rows ON intake_type, intake_condition, animal_type, age_band, census_band
        INTO NAME feature VALUE category)
  GROUP BY backtest_month, feature, category"""
_CTES["psi"] = """
  SELECT intake_month, feature, sum((a - e) * ln(a / e)) AS psi
  FROM (SELECT intake_month, feature,
               greatest(0.005::DOUBLE, coalesce(expected / nullif(sum(expected) OVER w, 0), 0)) AS e,
               greatest(0.005::DOUBLE, coalesce(actual / nullif(sum(actual) OVER w, 0), 0)) AS a
        FROM shifts WINDOW w AS (PARTITION BY intake_month, feature))
  GROUP BY intake_month, feature"""

# --- encoders ---------------------------------------------------------------------------

_CATEGORICAL = ("animal_type, intake_type, intake_condition, reproductive_status, is_mix, primary_breed, "
                "primary_color, jurisdiction, intake_month, intake_weekday")
_NUMERIC = "age_at_intake_days, stay_sequence, census_same_type"
_CTES["train_rows"] = "SELECT features.* FROM features, holdout WHERE intake_at >= train_start AND intake_at < train_end"
_CTES["test_rows"] = "SELECT features.* FROM features, holdout WHERE intake_at >= score_start AND intake_at < score_end"
_CTES["train_categories"] = f"""
  SELECT feature, category, n_categories > 40 AS bucketed, n_categories <= 40 OR place <= 39 AS kept
  FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) AS place,
               count(*) OVER (PARTITION BY feature) AS n_categories
        FROM (SELECT feature, category, count(*) AS n FROM (UNPIVOT train_rows ON {_CATEGORICAL} INTO NAME feature VALUE category)
              GROUP BY feature, category))"""
_CTES["codes"] = """
  SELECT feature, category, bucketed, kept,
         CASE WHEN kept THEN row_number() OVER (PARTITION BY feature, kept ORDER BY category) - 1 ELSE 39 END AS code
  FROM train_categories"""
_CTES["test_categories"] = f"""
  SELECT stay_key, feature, category, is_long_stay FROM (UNPIVOT test_rows ON {_CATEGORICAL} INTO NAME feature VALUE category)"""
_CTES["bucketed_features"] = "SELECT DISTINCT feature FROM train_categories WHERE bucketed"


def _numbers(rows: str, keep: str) -> str:
    """Numbers in long form, missing ones as null rows."""
    return " UNION ALL ".join(f"SELECT {keep}, '{c}' AS feature, {c} AS v FROM {rows}" for c in _NUMERIC.split(", "))


_CTES["train_numbers"] = _numbers("train_rows", "stay_key, is_long_stay")
_CTES["test_numbers"] = _numbers("test_rows", "stay_key, is_long_stay")
_CTES["number_stats"] = """
  SELECT feature, median, avg(coalesce(v, median)) AS mean, stddev_pop(coalesce(v, median)) AS sd,
         avg(cast(v IS NULL AS INTEGER)) AS gap_share
  FROM train_numbers JOIN (SELECT feature, coalesce(quantile_cont(v, 0.5), 0) AS median FROM train_numbers GROUP BY feature) USING (feature)
  GROUP BY feature, median"""


def _linear(categories: str, numbers: str) -> str:
    """(stay_key, is_long_stay, slot, value) of one-hot categories and scaled numbers."""
    return f"""
  SELECT stay_key, is_long_stay, feature || '=' || CASE WHEN c.kept THEN category ELSE 'infrequent' END AS slot, 1::DOUBLE AS value
  FROM {categories} LEFT JOIN train_categories c USING (feature, category)
  WHERE c.kept OR feature IN (SELECT feature FROM bucketed_features)
  UNION ALL
  SELECT stay_key, is_long_stay, feature || '_value', (coalesce(v, median) - mean) / CASE WHEN sd = 0 THEN 1 ELSE sd END
  FROM {numbers} JOIN number_stats USING (feature)
  UNION ALL
  SELECT stay_key, is_long_stay, feature || '_missing',
         (cast(v IS NULL AS INTEGER) - gap_share) / CASE WHEN gap_share IN (0, 1) THEN 1 ELSE sqrt(gap_share * (1 - gap_share)) END
  FROM {numbers} JOIN number_stats USING (feature) WHERE gap_share > 0"""


_CTES["train_unpivoted"] = f"""
  SELECT stay_key, feature, category, is_long_stay FROM (UNPIVOT train_rows ON {_CATEGORICAL} INTO NAME feature VALUE category)"""
_CTES["linear_test"] = _linear("test_categories", "test_numbers")
_CTES["linear_train"] = _linear("train_unpivoted", "train_numbers")
_CTES["importance_order"] = """
  SELECT stay_key, row_number() OVER (ORDER BY md5('20261005:' || stay_key), stay_key) AS place
  FROM test_rows QUALIFY place <= 15000"""
_CTES["recalibration_rows"] = """
  SELECT fit, ln(q / (1 - q)) AS z, y
  FROM (SELECT fit, y, greatest(1e-6::DOUBLE, least(1 - 1e-6::DOUBLE, p)) AS q
        FROM (SELECT 'related' AS fit, p * 0.5::DOUBLE + y * 0.25::DOUBLE + 0.125::DOUBLE AS p, y FROM scored
              UNION ALL SELECT 'unrelated', p, y FROM scored))"""
_CTES["newton"] = """
  SELECT 0 AS step, fit, 0::DOUBLE AS slope, 0::DOUBLE AS intercept FROM (SELECT DISTINCT fit FROM recalibration_rows)
  UNION ALL
  SELECT step + 1, fit, slope - (h00 * g1 - h01 * g0) / (h11 * h00 - h01 * h01), intercept - (h11 * g0 - h01 * g1) / (h11 * h00 - h01 * h01)
  FROM (SELECT step, fit, slope, intercept, s.g0, s.g1 + slope / 100 AS g1, s.h00, s.h01, s.h11 + 0.01::DOUBLE AS h11
        FROM (SELECT n.*, (SELECT {'g0': sum(p - y), 'g1': sum((p - y) * z), 'h00': sum(p * (1 - p)),
                                   'h01': sum(p * (1 - p) * z), 'h11': sum(p * (1 - p) * z * z)}
                           FROM (SELECT z, y, 1 / (1 + exp(-(n.slope * z + n.intercept))) AS p
                                 FROM recalibration_rows r WHERE r.fit = n.fit)) AS s
              FROM newton n WHERE step < 40))"""
_CTES["shift_halving"] = """
  SELECT 0 AS step, fit, -20::DOUBLE AS low, 20::DOUBLE AS high FROM (SELECT DISTINCT fit FROM recalibration_rows)
  UNION ALL
  SELECT step + 1, fit, CASE WHEN gap > 0 THEN low ELSE middle END, CASE WHEN gap > 0 THEN middle ELSE high END
  FROM (SELECT step, fit, low, high, (low + high) / 2 AS middle,
               (SELECT avg(1 / (1 + exp(-(z + (h.low + h.high) / 2))) - y) FROM recalibration_rows r WHERE r.fit = h.fit) AS gap
        FROM shift_halving h WHERE step < 60)"""

# --- checks -----------------------------------------------------------------------------

_TABLES = {
    "raw_intakes": "raw_starts", "raw_outcomes": "raw_ends", "staged_intakes": "starts",
    "staged_outcomes": "ends", "episode_fact": "fact", "entity_dimension": "dimension",
    "monthly_outcomes": "mart", "quality_issues": "issues",
}


def _results(*checks: tuple[str, str, str, str, str]) -> str:
    """(kind, table, column, severity, failing predicate) as one row each."""
    return "\nUNION ALL ".join(
        f"SELECT '{kind}' AS check_name, '{table}' AS table_name, '{column}' AS column_name, "
        f"'{severity}' AS severity, count(*) AS failing_rows FROM {_TABLES[table]} WHERE {failing}"
        for kind, table, column, severity, failing in checks
    )


def _not_null(table: str, *columns: str):
    return [("not_null", table, c, "error", f"{c} IS NULL") for c in columns]


def _accepted(table: str, column: str, severity: str, *values: str):
    listed = ", ".join(f"'{v}'" for v in values)
    return ("accepted_values", table, column, severity, f"{column} NOT IN ({listed})")


def _in_range(table: str, column: str, severity: str, inside: str):
    return ("accepted_range", table, column, severity, f"NOT ({inside.replace('#', column)})")


def _unique(table: str, column: str) -> str:
    return (
        f"SELECT 'unique' AS check_name, '{table}' AS table_name, '{column}' AS column_name, 'error' AS severity, "
        f"count(*) AS failing_rows FROM (SELECT {column} FROM {_TABLES[table]} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


def statement(final: str) -> str:
    """The final SELECT behind every CTE it can reach."""
    needed, todo = set(), [final]
    while todo:
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in todo.pop()).split())
        for name in _CTES:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(_CTES[name])
    body = ",\n".join(f"{name} AS ({_CTES[name]})" for name in _CTES if name in needed)
    return f"WITH RECURSIVE {body}\n{final}"


_ROUNDED = "n, " + ", ".join(
    f"round({m}, 6) AS {m}"
    for m in ("base_rate", "mean_predicted", "roc_auc", "average_precision", "brier", "top_decile_precision",
              "top_decile_lift")
)


def _rounded_metrics(source: str) -> str:
    return f"SELECT slice, {_ROUNDED} FROM {source}"


ORACLES: dict[str, str] = {
    "landed_starts": "SELECT * FROM raw_starts",
    "landed_ends": "SELECT * FROM raw_ends",
    "load_reconciliation": """
        SELECT 'intakes' AS feed, count(*) AS landed_rows, count(*) AS loaded_rows FROM raw_starts
        UNION ALL SELECT 'outcomes', count(*), count(*) FROM raw_ends""",
    "absent_columns": """
        SELECT 'intakes' AS feed, 'found_location' AS column_name, cast(0 AS BIGINT) AS filled_rows, count(*) AS loaded_rows
        FROM raw_starts""",
    "required_keys": """
        SELECT 'intakes' AS feed, count(*) AS raw_rows, count_if(animal_id IS NOT NULL AND datetime IS NOT NULL) AS kept_rows
        FROM raw_starts
        UNION ALL SELECT 'outcomes', count(*), count_if(animal_id IS NOT NULL AND datetime IS NOT NULL) FROM raw_ends""",
    "dedupe_exact": """
        SELECT 'intakes' AS feed, (SELECT count(*) FROM raw_starts WHERE datetime IS NOT NULL) AS keyed_rows,
               (SELECT count(*) FROM typed_starts) AS distinct_rows
        UNION ALL SELECT 'outcomes', (SELECT count(*) FROM raw_ends), (SELECT count(*) FROM typed_ends)""",
    "clean_label_values": f"""
        SELECT DISTINCT raw_value, {_label('raw_value')} AS label
        FROM (SELECT intake_type AS raw_value FROM raw_starts UNION ALL SELECT intake_condition FROM raw_starts
              UNION ALL SELECT outcome_type FROM raw_ends UNION ALL SELECT outcome_subtype FROM raw_ends)""",
    "age_text_days": f"""
        SELECT DISTINCT age_text, {_age('age_text')} AS age_days
        FROM (SELECT age_upon_intake AS age_text FROM raw_starts UNION ALL SELECT age_upon_outcome FROM raw_ends)""",
    "surrogate_keys": f"""
        SELECT DISTINCT animal_id, name, {_key('animal_id', 'name')} AS digest FROM raw_starts""",
    "stage_starts": """
        SELECT stay_key, animal_id, stay_sequence, intake_at, animal_name, found_location, intake_type,
               intake_condition, animal_type, sex_upon_intake, age_at_intake_days, breed, color FROM starts""",
    "stage_ends": """
        SELECT stay_key, animal_id, stay_sequence, outcome_at, date_of_birth, animal_name, outcome_type,
               outcome_subtype, animal_type, sex_upon_outcome, age_at_outcome_days, breed, color FROM ends""",
    "paired_episodes": "SELECT * FROM episodes",
    "orphan_ends": "SELECT stay_key, animal_id, stay_sequence, outcome_at, outcome_type FROM ends ANTI JOIN starts USING (stay_key)",
    "episode_fact": "SELECT * FROM fact",
    "entity_dimension": "SELECT * FROM dimension",
    "monthly_outcomes": """
        SELECT * REPLACE (round(median_length_of_stay_days, 6) AS median_length_of_stay_days,
                          round(p90_length_of_stay_days, 6) AS p90_length_of_stay_days) FROM mart""",
    "published_monthly_outcomes": """
        SELECT * REPLACE (round(median_length_of_stay_days, 6) AS median_length_of_stay_days,
                          round(p90_length_of_stay_days, 6) AS p90_length_of_stay_days) FROM mart""",
    "quality_issues": "SELECT * FROM issues",
    "quality_issue_counts": "SELECT issue_type, count(*) AS issues FROM issues GROUP BY issue_type",
    "check_not_null": _results(
        *_not_null("raw_intakes", "animal_id", "datetime"),
        *_not_null("raw_outcomes", "animal_id", "datetime"),
        *_not_null("staged_intakes", "stay_key", "animal_id", "stay_sequence", "intake_at"),
        *_not_null("staged_outcomes", "stay_key", "animal_id", "stay_sequence", "outcome_at"),
        *_not_null("episode_fact", "stay_key", "animal_id", "is_return_stay", "is_open_stay",
                   "is_owner_requested_euthanasia"),
        *_not_null("entity_dimension", "animal_id", "stay_count", "has_returned", "is_currently_in_care"),
        *_not_null("monthly_outcomes", "outcome_month", "outcomes_total"),
        *_not_null("quality_issues", "stay_key", "issue_type"),
    ),
    "check_unique": " UNION ALL ".join([
        _unique("staged_intakes", "stay_key"), _unique("staged_outcomes", "stay_key"),
        _unique("episode_fact", "stay_key"), _unique("entity_dimension", "animal_id"),
    ]),
    "check_accepted_values": _results(
        _accepted("staged_intakes", "intake_type", "warn", "Stray", "Owner Surrender", "Public Assist",
                  "Wildlife", "Abandoned", "Euthanasia Request"),
        _accepted("staged_outcomes", "outcome_type", "warn", "Adoption", "Transfer", "Return To Owner",
                  "Rto-Adopt", "Euthanasia", "Died", "Disposal", "Missing"),
        _accepted("episode_fact", "outcome_class", "error", "Live", "Non-Live", "Unknown"),
        _accepted("episode_fact", "age_band_at_intake", "warn", "Under 6 months", "6 to 12 months",
                  "1 to 3 years", "3 to 7 years", "7 years and over"),
        _accepted("quality_issues", "issue_type", "error", "outcome_before_intake",
                  "unrecognised_outcome_type", "unusable_age_at_intake", "outcome_without_intake"),
    ),
    "check_accepted_range": _results(
        _in_range("staged_intakes", "stay_sequence", "error", "# >= 1"),
        _in_range("staged_intakes", "age_at_intake_days", "warn", "# BETWEEN 0 AND 10950"),
        _in_range("episode_fact", "length_of_stay_days", "error", "# >= 0"),
        _in_range("entity_dimension", "stay_count", "error", "# >= 1"),
        _in_range("monthly_outcomes", "outcomes_total", "error", "# >= 1"),
        _in_range("monthly_outcomes", "live_release_rate_pct", "error", "# BETWEEN 0 AND 100"),
        _in_range("monthly_outcomes", "live_release_rate_adjusted_pct", "error", "# BETWEEN 0 AND 100"),
        _in_range("monthly_outcomes", "median_length_of_stay_days", "error", "# >= 0"),
    ),
    "check_relationships": """
        SELECT 'relationships' AS check_name, 'episode_fact' AS table_name, 'animal_id' AS column_name,
               'error' AS severity, count(*) AS failing_rows
        FROM fact WHERE animal_id NOT IN (SELECT animal_id FROM dimension)""",
    "failing_outcome_types": """
        SELECT outcome_type AS failing_value, count(*) AS failing_rows FROM ends
        WHERE outcome_type NOT IN ('Adoption', 'Transfer', 'Return To Owner', 'Rto-Adopt', 'Euthanasia', 'Died',
                                   'Disposal', 'Missing')
        GROUP BY outcome_type""",
    "failing_ages": """
        SELECT age_at_intake_days AS failing_value, count(*) AS failing_rows FROM starts
        WHERE age_at_intake_days <= 30 OR age_at_intake_days >= 730 GROUP BY age_at_intake_days""",
    "assert_warehouse": """
        SELECT 'no_negative_duration' AS check_name, 'episode_fact' AS table_name,
               'length_of_stay_days' AS column_name, 'error' AS severity, count(*) AS failing_rows
        FROM fact WHERE length_of_stay_days < 0
        UNION ALL SELECT 'open_flag_agrees', 'episode_fact', 'is_open_stay', 'error', count(*) FROM fact
        WHERE (is_open_stay AND outcome_at IS NOT NULL) OR (NOT is_open_stay AND outcome_at IS NULL)
        UNION ALL SELECT 'monthly_counts_reconcile', 'monthly_outcomes', 'outcomes_total', 'error', count(*)
        FROM (SELECT sum(outcomes_total) AS n FROM mart) m, (SELECT count(*) AS n FROM fact WHERE NOT is_open_stay) f
        WHERE m.n <> f.n
        UNION ALL SELECT 'live_rate_matches_components', 'monthly_outcomes', 'live_release_rate_pct', 'error', count(*)
        FROM mart WHERE outcomes_live + outcomes_non_live > 0
          AND abs(live_release_rate_pct - round(100.0 * outcomes_live / (outcomes_live + outcomes_non_live), 2)) > 0.01
        UNION ALL SELECT 'outcomes_accounted', 'staged_outcomes', 'stay_key', 'error', count(*)
        FROM (SELECT (SELECT count(*) FROM ends) AS staged,
                     (SELECT count(*) FROM fact WHERE NOT is_open_stay)
                     + (SELECT count(DISTINCT stay_key) FROM issues
                        WHERE issue_type IN ('outcome_without_intake', 'outcome_before_intake')) AS accounted)
        WHERE staged <> accounted""",
    "trend_adoption_median": """
        SELECT cast(year(outcome_date) AS INTEGER) AS outcome_year, animal_type, count(*) AS stays,
               cast(median(length_of_stay_days) AS DOUBLE) AS median_days
        FROM fact WHERE NOT is_open_stay AND outcome_type = 'Adoption' AND animal_type IN ('Dog', 'Cat')
          AND year(outcome_date) BETWEEN (SELECT first_year FROM whole_years) AND (SELECT last_year FROM whole_years) GROUP BY 1, 2""",
    "trend_median_by_exit": """
        SELECT cast(year(outcome_date) AS INTEGER) AS outcome_year, outcome_type, count(*) AS stays,
               cast(median(length_of_stay_days) AS DOUBLE) AS median_days
        FROM fact WHERE NOT is_open_stay AND animal_type = 'Dog' AND year(outcome_date) BETWEEN (SELECT first_year FROM whole_years) AND (SELECT last_year FROM whole_years)
        GROUP BY 1, 2""",
    "trend_live_rate": f"""
        SELECT cast(year(outcome_date) AS INTEGER) AS outcome_year, count(*) AS stays,
               {_pct("count_if(outcome_class = 'Live')", "count_if(outcome_class IN ('Live', 'Non-Live'))")}
                 AS live_release_rate_pct
        FROM fact WHERE NOT is_open_stay AND animal_type IN ('Dog', 'Cat') AND year(outcome_date) BETWEEN (SELECT first_year FROM whole_years) AND (SELECT last_year FROM whole_years)
        GROUP BY 1""",
    "trend_exit_mix": """
        SELECT outcome_year, outcome_type, stays,
               round(100.0 * stays / sum(stays) OVER (PARTITION BY outcome_year), 2) AS share_pct
        FROM (SELECT cast(year(outcome_date) AS INTEGER) AS outcome_year, outcome_type, count(*) AS stays FROM fact
              WHERE NOT is_open_stay AND animal_type IN ('Dog', 'Cat') AND year(outcome_date) BETWEEN (SELECT first_year FROM whole_years) AND (SELECT last_year FROM whole_years)
              GROUP BY 1, 2)""",
    "trend_adoption_p90": """
        SELECT cast(year(outcome_date) AS INTEGER) AS outcome_year, animal_type, count(*) AS stays,
               round(cast(quantile_cont(length_of_stay_days, 0.9) AS DOUBLE), 6) AS p90_days
        FROM fact WHERE NOT is_open_stay AND outcome_type = 'Adoption' AND animal_type IN ('Dog', 'Cat')
          AND year(outcome_date) BETWEEN (SELECT first_year FROM whole_years) AND (SELECT last_year FROM whole_years) GROUP BY 1, 2""",
    "trend_adjusted_gap": """
        SELECT count(live_release_rate_adjusted_pct - live_release_rate_pct) AS groups,
               round(avg(live_release_rate_adjusted_pct - live_release_rate_pct), 6) AS mean_gap_points FROM mart""",
    "trend_longest_history": """
        SELECT max(stays) AS most_stays, count(*) AS animals
        FROM (SELECT animal_id, count(*) AS stays FROM fact GROUP BY animal_id)""",
    "trend_start_volume": "SELECT intake_month, animal_type, count(*) AS intakes FROM fact GROUP BY 1, 2",
    "daily_census": "SELECT * FROM census",
    "training_frame": "SELECT * FROM frame",
    "population_horizon": """
        SELECT as_of, label_cutoff, feed_start,
               (SELECT count(*) FROM eligible WHERE implausible) AS excluded_implausible_open FROM horizon""",
    "labels": "SELECT stay_key, intake_at, is_long_stay FROM labelled",
    "feature_frame": "SELECT * FROM features",
    "scoring_population": """
        SELECT stay_key, animal_id, animal_type, intake_at, days_in_care
        FROM (SELECT *, cast(floor(epoch(as_of - intake_at) / 86400) AS BIGINT) AS days_in_care
              FROM eligible WHERE NOT mature AND is_open_stay)
        WHERE days_in_care < 30""",
    "risk_bands": """
        SELECT stay_key, CASE WHEN p >= high THEN 'High' WHEN p >= elevated THEN 'Elevated' ELSE 'Typical' END AS risk_band
        FROM (SELECT stay_key, cast('0x' || substr(stay_key, 1, 3) AS BIGINT) / 4096.0::DOUBLE AS p,
                     floor(epoch(as_of - intake_at) / 86400) AS days
              FROM eligible WHERE NOT mature AND is_open_stay),
             (SELECT quantile_cont(p, 0.9) AS high, quantile_cont(p, 0.7) AS elevated FROM scored)
        WHERE days < 30""",
    "misplaced_scores": """
        SELECT stay_key FROM fact, horizon
        WHERE NOT is_open_stay OR floor(epoch(as_of - intake_at) / 86400) >= 30""",
    "rare_category_map": """
        SELECT feature, category, n,
               CASE WHEN n_categories <= 40 OR place <= 39 THEN category ELSE 'infrequent' END AS grouped
        FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) AS place,
                     count(*) OVER (PARTITION BY feature) AS n_categories
              FROM (SELECT feature, category, count(*) AS n
                    FROM (UNPIVOT (SELECT features.* FROM features, holdout
                                   WHERE intake_at >= train_start AND intake_at < train_end)
                          ON animal_type, intake_type, intake_condition, reproductive_status, is_mix, primary_breed,
                             primary_color, jurisdiction, intake_month, intake_weekday
                          INTO NAME feature VALUE category)
                    GROUP BY feature, category))""",
    "holdout_calendar": "SELECT * FROM holdout",
    "backtest_calendar": "SELECT * FROM months",
    "model_metrics": _rounded_metrics("holdout_metrics"),
    "sensitivity_slice": _rounded_metrics("slice_metrics"),
    "calibration_deciles": """
        SELECT slice, decile, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(y), 6) AS observed_rate
        FROM (SELECT *, greatest(1, (10 * (position - 1) + n - 2) // (n - 1)) AS decile FROM places)
        GROUP BY slice, decile""",
    "top_decile": """
        SELECT stay_key, p, cast(y AS BIGINT) AS y, position FROM places
        WHERE position > n - greatest(1, cast(round_even(n * 0.1::DOUBLE, 0) AS BIGINT))""",
    "recalibrated_scores": """
        SELECT stay_key, round(1 / (1 + exp(-(0.8::DOUBLE * ln(q / (1 - q)) - 0.25::DOUBLE))), 6) AS probability
        FROM (SELECT stay_key, greatest(1e-6::DOUBLE, least(1 - 1e-6::DOUBLE, p)) AS q FROM scored)""",
    "level_shift": """
        , z_rows AS (SELECT ln(q / (1 - q)) AS z, y
                     FROM (SELECT y, greatest(1e-6::DOUBLE, least(1 - 1e-6::DOUBLE, p)) AS q FROM scored)),
        halving AS (
          SELECT 0 AS step, -20::DOUBLE AS low, 20::DOUBLE AS high
          UNION ALL
          SELECT step + 1, CASE WHEN gap > 0 THEN low ELSE middle END, CASE WHEN gap > 0 THEN middle ELSE high END
          FROM (SELECT step, low, high, (low + high) / 2 AS middle,
                       (SELECT avg(1 / (1 + exp(-(z + (h.low + h.high) / 2))) - y) FROM z_rows) AS gap
                FROM halving h WHERE step < 60)),
        found AS (SELECT low AS b FROM halving WHERE step = 60)
        SELECT count(*) AS n, round(avg(y), 6) AS target_rate,
               round(avg(1 / (1 + exp(-(z + b)))), 6) AS shifted_mean, round(max(b), 4) AS shift
        FROM z_rows, found""",
    "drift_bands": "SELECT * FROM shifts",
    "psi_by_month": "SELECT intake_month, feature, round(psi, 6) AS psi FROM psi",
    "month_status": f"""
        SELECT slice AS intake_month, {_ROUNDED}, round(mean_predicted - base_rate, 6) AS calibration_gap,
               CASE WHEN n < 200 THEN 'insufficient_data'
                    WHEN roc_auc < 0.65 OR abs(mean_predicted - base_rate) > 0.05 THEN 'review' ELSE 'ok' END AS status,
               nullif(concat_ws(', ', CASE WHEN roc_auc < 0.65 THEN 'auc_below_floor' END,
                                CASE WHEN abs(mean_predicted - base_rate) > 0.05 THEN 'calibration_gap' END), '')
                 AS review_reasons,
               round(max_feature_psi, 6) AS max_feature_psi, drifted_features
        FROM month_metrics JOIN (
          SELECT intake_month, max(psi) AS max_feature_psi,
                 string_agg(feature, ', ' ORDER BY list_position(['intake_type', 'intake_condition', 'animal_type',
                            'age_band', 'census_band'], feature)) FILTER (psi > 0.25) AS drifted_features
          FROM psi GROUP BY intake_month) d ON d.intake_month = slice""",
    "landed_keys": " UNION ALL ".join(
        f"SELECT '{c}' AS key, '{status}' AS status, {objects} AS objects, {filled} AS filled FROM raw_starts"
        for c, status, objects, filled in (
            *((c, "present", "count(*)", f"count({c})") for c in (
                "animal_id", "name", "datetime", "intake_type", "intake_condition", "animal_type", "sex_upon_intake",
                "age_upon_intake", "breed")),
            ("color", "null", "count(*)", "cast(0 AS BIGINT)"),
            ("found_location", "absent", "0 * count(*)", "0 * count(*)"),
            ("note", "unexpected", "count(*)", "count(name)"),
        )
    ),
    "encoded_tree": f"""
        SELECT stay_key, feature AS slot, cast(coalesce(code, -1) AS DOUBLE) AS value
        FROM test_categories LEFT JOIN codes USING (feature, category)
        UNION ALL SELECT stay_key, feature, round(coalesce(v, -1), 6) FROM test_numbers
        UNION ALL SELECT stay_key, feature || '_missing', cast(v IS NULL AS DOUBLE) FROM test_numbers""",
    "encoded_linear": """
        SELECT stay_key, slot, round(value, 6) AS value FROM linear_test WHERE round(value, 6) <> 0""",
    "baseline_optimality": """
        SELECT slot, round(sum(value * is_long_stay), 2) AS observed, round(sum(value * is_long_stay), 2) AS fitted
        FROM (SELECT slot, value, is_long_stay FROM linear_train
              UNION ALL SELECT 'intercept', 1::DOUBLE, is_long_stay FROM train_rows)
        GROUP BY slot""",
    "backtest_rows": """
        SELECT score_start AS intake_month,
               count_if(intake_at >= train_start AND intake_at < train_end) AS train_rows,
               count_if(intake_at >= calibration_start AND intake_at < train_end) AS calibration_rows,
               count_if(intake_at >= score_start AND intake_at < score_end) AS test_rows,
               count(DISTINCT CASE WHEN intake_at >= train_start AND intake_at < train_end THEN is_long_stay END) AS classes,
               test_rows > 0 AND classes = 2 AS usable
        FROM months LEFT JOIN features ON intake_at >= train_start AND intake_at < score_end
        GROUP BY score_start""",
    "check_windows": """
        SELECT *, 'error' AS severity, 'model' AS check_group FROM (
          SELECT 'not_null' AS check_name, 'monthly_performance' AS table_name, 'intake_month' AS column_name, count_if(score_start IS NULL) AS failing_rows FROM months
          UNION ALL SELECT 'not_null', 'monthly_performance', 'train_end', count_if(train_end IS NULL) FROM months
          UNION ALL SELECT 'accepted_range', 'monthly_performance', 'classes', cast(0 AS BIGINT)
          UNION ALL SELECT 'accepted_range', 'monthly_performance', 'train_rows', cast(0 AS BIGINT)
          UNION ALL SELECT 'unique', 'monthly_performance', 'intake_month', count(*) - count(DISTINCT score_start) FROM months
          UNION ALL SELECT 'not_null', 'model_evaluation', 'model', cast(0 AS BIGINT)
          UNION ALL SELECT 'not_null', 'model_evaluation', 'train_end', 3 * count_if(train_end IS NULL) FROM holdout
          UNION ALL SELECT 'unique', 'model_evaluation', 'model', cast(0 AS BIGINT)
          UNION ALL SELECT 'backtest_trained_before_scored', 'monthly_performance', 'train_end',
                           count_if(train_end > score_start - INTERVAL 30 DAY) FROM months
          UNION ALL SELECT 'holdout_trained_before_holdout', 'model_evaluation', 'train_end',
                           3 * count_if(train_end > score_start - INTERVAL 30 DAY) FROM holdout)""",
    "importance_donors": """
        SELECT cast(repeat AS INTEGER) AS repeat, o.stay_key, d.stay_key AS donor
        FROM (SELECT i AS repeat, stay_key,
                     row_number() OVER (PARTITION BY i ORDER BY md5('20261005:' || i || ':' || stay_key), stay_key) AS place
              FROM importance_order, range(1, 6) t(i)) d
        JOIN importance_order o USING (place)""",
    "no_signal": "SELECT 0.6::DOUBLE AS auc_limit, true AS passed FROM horizon",
    "recalibration_fit": """
        SELECT fit, round(CASE WHEN slope > 0 THEN slope ELSE 1 END, 5) AS slope,
               round(CASE WHEN slope > 0 THEN intercept ELSE low END, 5) AS intercept
        FROM newton JOIN shift_halving USING (fit) WHERE newton.step = 40 AND shift_halving.step = 60""",
}


def oracle_sql() -> dict[str, str]:
    return {name: statement(final) for name, final in ORACLES.items()}
