"""For each query the same result as SQL over the given tables, in DuckDB's dialect."""

from __future__ import annotations

from parity.inputs import DAMAGED, TINY, SQL_ANY_RENTALS, SQL_AREAS, SQL_LISTINGS, SQL_RENTALS, SQL_RENTALS_ARRAYS, sql_inside


def _formatted(code: str) -> str:
    return (
        f"case when length({code}) in (4, 7) then {code} "
        f"when length({code}) = 6 then concat(substr({code}, 1, 4), ' ', substr({code}, 5)) end"
    )


def _pc4(code: str) -> str:
    return f"regexp_extract({code}, '(\\d{{4}})', 1)"


RENT = "try_cast(regexp_extract(rent, '€\\s*(\\d+)', 1) as double)"
AREA = "try_cast(regexp_extract(\"areaSqm\", '(\\d+)', 1) as double)"
UTILITIES = "contains(rent, 'Utilities incl.')"

WITH = f"""with recursive listings as ({SQL_LISTINGS}),
 rentals as ({SQL_RENTALS}),
 rental_arrays as ({SQL_RENTALS_ARRAYS}),
 areas as ({SQL_AREAS}),
 formatted as (select *, {_formatted('zipcode')} as zipcode_formatted from listings),
 coordinates as (select distinct latitude, longitude from listings where latitude is not null and longitude is not null),
 missing as (select distinct latitude, longitude from formatted
   where zipcode_formatted is null and latitude is not null and longitude is not null),
 pairs as (select latitude, longitude, postcode from (select *, try_cast(longitude as double) as x,
   try_cast(latitude as double) as y from coordinates) p, areas where {sql_inside('x', 'y')}),
 located as (select pairs.* from pairs join missing using (latitude, longitude)),
 filled as (select f.*, l.postcode, coalesce(zipcode_formatted, l.postcode) as final_zipcode
   from formatted f left join located l using (latitude, longitude)),
 silver_listings as (select * replace (cast(price as double) as price,
     try_cast(review_scores_value as double) as review_scores_value, try_cast(bedrooms as double) as bedrooms),
     {_pc4('final_zipcode')} as postalcode4
   from filled where {_pc4('final_zipcode')} <> '' and try_cast(price as double) is not null),
 exploded as (select rental_arrays.* exclude ("crawledAt", "firstSeenAt"), c.v as "crawledAt", s.v as "firstSeenAt"
   from rental_arrays, unnest("crawledAt") as c(v), unnest("firstSeenAt") as s(v)),
 silver_rentals as (select *, {_formatted('"postalCode"')} as zipcode_formatted, {_pc4('"postalCode"')} as postalcode4,
     {RENT} as monthly_rent, {UTILITIES} as utilities_included, {AREA} as area_sqm
   from exploded where {_pc4('"postalCode"')} <> '' and {RENT} > 0)"""


def _mean(column: str, digits: int) -> str:
    exact = f"cast({column} as decimal(18,2))"
    return f"cast(round(cast(sum({exact}) / count({column}) as decimal(28,10)), {digits}) as double)"


def _rank(column: str) -> str:
    return f"cast(rank() over (order by {column} desc nulls last) as integer)"


def _cents(column: str) -> str:
    return f"cast({column} as decimal(18,2))"


def _gold(occupancy: str, days: int, months: int, before: str = WITH, listings: str = "silver_listings", rentals: str = "silver_rentals") -> str:
    return f"""{before},
 short_sums as (select postalcode4, {_mean('price', 2)} as avg_nightly_price,
   {_mean('review_scores_value', 1)} as avg_review_score, {_mean('bedrooms', 1)} as avg_bedrooms,
   count(*) as airbnb_listing_count from {listings} group by postalcode4),
 short_revenue as (select *, cast(round({_cents('avg_nightly_price')} * {days} * {occupancy}, 2) as double)
   as est_annual_airbnb_revenue from short_sums),
 short_term as (select *, {_rank('est_annual_airbnb_revenue')} as airbnb_revenue_rank,
   cast({occupancy} as double) as occupancy_rate from short_revenue),
 long_sums as (select postalcode4, {_mean('monthly_rent', 2)} as avg_monthly_rent,
   {_mean('area_sqm', 1)} as avg_area_sqm, count(*) as rental_listing_count from {rentals} group by postalcode4),
 long_revenue as (select *, cast(round({_cents('avg_monthly_rent')} * {months}, 2) as double)
   as est_annual_rental_revenue from long_sums),
 long_term as (select *, {_rank('est_annual_rental_revenue')} as rental_revenue_rank from long_revenue),
 compared as (select *, cast({_cents('est_annual_airbnb_revenue')} - {_cents('est_annual_rental_revenue')} as double)
     as revenue_airbnb_minus_rentals,
   cast(round(cast({_cents('est_annual_airbnb_revenue')} / {_cents('est_annual_rental_revenue')} as decimal(28,10)), 2)
     as double) as revenue_ratio,
   airbnb_listing_count + rental_listing_count as total_listings
   from short_term join long_term using (postalcode4)),
 comparison as (select *, case when revenue_airbnb_minus_rentals > 0 then 'Airbnb (Short-term)'
   else 'Kamernet (Long-term)' end as recommended_strategy,
   {_rank('revenue_airbnb_minus_rentals')} as investment_rank from compared)"""


GOLD = _gold("0.50", 365, 12)

STRICT = f"""{WITH},
 strict as (select * replace (case when {_pc4('zipcode_formatted')} <> '' then zipcode_formatted end
   as zipcode_formatted) from formatted),
 strict_missing as (select distinct latitude, longitude from strict
   where zipcode_formatted is null and latitude is not null and longitude is not null),
 smallest as (select latitude, longitude, min(postcode) as postcode from pairs join strict_missing
   using (latitude, longitude) group by 1, 2)"""
FILLED_FIRST = f"""{STRICT} select listing_id, postcode, coalesce(zipcode_formatted, postcode) as final_zipcode
 from strict left join smallest using (latitude, longitude)"""

# Raw listings went through a file, where a blank text is NULL.
OPTIONS = _gold("0.50", 365, 12, f"""{STRICT},
 strict_filled as (select strict.*, smallest.postcode, coalesce(zipcode_formatted, smallest.postcode) as final_zipcode
   from strict left join smallest using (latitude, longitude)),
 strict_listings as (select distinct * replace (cast(price as double) as price,
     try_cast(review_scores_value as double) as review_scores_value, try_cast(bedrooms as double) as bedrooms),
     {_pc4('final_zipcode')} as postalcode4
   from strict_filled where {_pc4('final_zipcode')} <> '' and try_cast(price as double) is not null),
 zipped as (select rental_arrays.* exclude ("crawledAt", "firstSeenAt"), "crawledAt"[i] as "crawledAt", "firstSeenAt"[i] as "firstSeenAt"
   from rental_arrays, unnest(range(1, 1 + greatest(1, len("crawledAt"), coalesce(len("firstSeenAt"), 0)))) as u(i)),
 zipped_rentals as (select distinct *, {_pc4('"postalCode"')} as postalcode4, {RENT} as monthly_rent, {AREA} as area_sqm
   from zipped where {_pc4('"postalCode"')} <> '' and {RENT} > 0)""", "strict_listings", "zipped_rentals")

RUN_REPORT = f"""{OPTIONS},
 needy as (select * from strict where zipcode_formatted is null),
 places as (select latitude, longitude, count(*) as n, any_value(smallest.postcode) as postcode
   from needy left join smallest using (latitude, longitude)
   where latitude is not null and longitude is not null group by 1, 2),
 valid as (select greatest(1, len("crawledAt"), coalesce(len("firstSeenAt"), 0)) as n from rental_arrays
   where {_pc4('"postalCode"')} <> '' and {RENT} > 0)
 select (select count(*) from needy) as missing_listings,
   (select count(*) from needy where latitude is null or longitude is null) as unplaced_listings,
   count(*) as missing_coordinates, count(*) filter (where postcode is null) as unlocated_coordinates,
   cast(0 as bigint) as shared_coordinates, cast(sum(case when postcode is null then n else 0 end) as bigint) as unlocated_listings,
   cast(sum(case when postcode is not null then n else 0 end) as bigint) as located_rows,
   (select count(*) from valid) as rows_in, (select cast(sum(n) as bigint) from valid) as rows_out, cast(0 as bigint) as rows_lost,
   (select count(*) from strict_listings) as silver_listings, (select count(*) from zipped_rentals) as silver_rentals
 from places"""

ANY_RENTALS = f"""with any_rentals as ({SQL_ANY_RENTALS})"""
_ANY_NAMES = '"postalCode", rent, "areaSqm", floor, "city name"'
ANY_FIELDS = f"""{ANY_RENTALS} select order_id, cast(line_no as bigint) as line_no, {_ANY_NAMES}, _id, tags,
   cast(null as integer) as corrupt_length from any_rentals
 union all select null, null, null, null, null, null, null, null, null, 30 from lineitem where {DAMAGED}"""
DEFAULT_INGEST = f"""{ANY_RENTALS}, exploded as (select order_id, line_no, {_ANY_NAMES}, i.v as _id, t.v as tags
   from any_rentals, unnest(_id) as i(v), unnest(tags) as t(v))
 select order_id, cast(line_no as bigint) as line_no, {_ANY_NAMES}, _id, tags, {_formatted('"postalCode"')} as zipcode_formatted,
   {_pc4('"postalCode"')} as postalcode4, {RENT} as monthly_rent, {UTILITIES} as utilities_included, {AREA} as area_sqm,
   (select cast(count(*) as integer) from lineitem where {DAMAGED}) as bad_lines, cast(0 as integer) as bad_rows,
   (select cast(count(*) + count(*) filter (where {DAMAGED}) as integer) from lineitem) as n_rentals,
   (select cast(count(*) as integer) from orders) as n_listings
 from exploded where {_pc4('"postalCode"')} <> '' and {RENT} > 0"""

# A price text that is no finite number, or larger than exact sums reach: such groups are averaged as doubles.
_WILD = f"case when listing_id % 97 = 0 then 'NaN' when listing_id % 89 = 0 then 'Infinity' when listing_id % 83 = 0 then '{2**100}' else price end"
_FITS = "bool_and(price < 1e22)"
EXTREMES = f"""{WITH},
 wild as (select *, {_pc4('zipcode')} as postalcode4, try_cast({_WILD} as double) as price_number from listings),
 valid as (select * exclude (price, price_number), price_number as price from wild where postalcode4 <> '' and price_number is not null),
 sums as (select postalcode4, case when {_FITS} then {_mean("case when price < 1e22 then price end", 2)} else avg(price) end as avg_nightly_price,
   {_mean('try_cast(review_scores_value as double)', 1)} as avg_review_score, {_mean('try_cast(bedrooms as double)', 1)} as avg_bedrooms,
   count(*) as airbnb_listing_count from valid group by postalcode4),
 revenue as (select *, case when avg_nightly_price < 1e15 then cast(round(cast(case when avg_nightly_price < 1e15 then avg_nightly_price end
   as decimal(18,2)) * 182.5, 2) as double) else avg_nightly_price * cast(182.5 as double) end as est_annual_airbnb_revenue from sums)
 select * replace (case when not isnan(avg_nightly_price) then avg_nightly_price end as avg_nightly_price,
   case when not isnan(est_annual_airbnb_revenue) then est_annual_airbnb_revenue end as est_annual_airbnb_revenue),
   isnan(avg_nightly_price) as not_a_number, {_rank('est_annual_airbnb_revenue')} as airbnb_revenue_rank,
   cast(0.5 as double) as occupancy_rate from revenue"""

# Corners (dx, dy) around the middle of an area, by kind: ring number, members of the area, corner.
_DIAMOND = [(0, -1), (1, 0), (0, 1), (-1, 0), (0, -1)]


def _corners() -> str:
    def diamond(kind: str, ring: int, radius: float) -> list[str]:
        return [f"('{kind}', {ring}, 1, {dx * radius}, {dy * radius})" for dx, dy in _DIAMOND]

    def box(ring: int, left: float, right: float) -> list[str]:
        at = [(left, -0.45), (right, -0.45), (right, 0.45), (left, 0.45), (left, -0.45)]
        return [f"('boxes', {ring}, 2, {dx}, {dy})" for dx, dy in at]

    rows = [
        *diamond("diamond", 1, 0.5),
        *diamond("ring", 1, 0.5),
        *diamond("ring", 2, 0.2),
        *diamond("wide", 1, 1.2),
        *box(1, -0.45, -0.05),
        *box(2, 0.05, 0.45),
    ]
    return f"(values {', '.join(rows)}) as corner(kind, ring, members, dx, dy)"


def _trimmed(column: str) -> str:
    return f"nullif(trim({column}), '') as {column}"


_TEXTS = ["zipcode", "latitude", "longitude", "price", "bedrooms", "review_scores_value", "host_note"]

ORACLE: dict[str, str] = {
    "zipcode_format": f"""{WITH} select order_id, line_no, cast(length("postalCode") as integer) as code_length,
        {_formatted('"postalCode"')} as zipcode_formatted from rentals""",
    "pc4_extract": f"""{WITH} select order_id, line_no, {_pc4('"postalCode"')} as postalcode4 from rentals
        where {_pc4('"postalCode"')} <> ''""",
    "rent_parse": f"""{WITH} select order_id, line_no, {RENT} as monthly_rent, {AREA} as area_sqm,
        {UTILITIES} as utilities_included from rentals""",
    "null_fill_unknown": f"""{WITH} select listing_id, {', '.join(f"coalesce({c}, 'Unknown') as {c}" for c in _TEXTS)}
        from listings""",
    "trim_blank_to_null": f"{WITH} select listing_id, {', '.join(map(_trimmed, _TEXTS))} from listings",
    "valid_listings": f"""{WITH} select listing_id, {_pc4('zipcode')} as postalcode4, try_cast(price as double) as price,
        try_cast(bedrooms as double) as bedrooms, try_cast(review_scores_value as double) as review_scores_value
        from listings where {_pc4('zipcode')} <> '' and try_cast(price as double) is not null""",
    "without_any_null": f"""{WITH} select * from listings where {' and '.join(f'{c} is not null' for c in _TEXTS)}""",
    "struct_flatten": f"""{WITH} select listing_id, zipcode as place_zipcode, latitude as place_point_latitude,
        longitude as place_point_longitude, price as offer_price from listings""",
    "explode_chain": f"""{WITH} select order_id, line_no, "crawledAt", "firstSeenAt" from exploded""",
    "explode_zip": f"""{WITH} select order_id, line_no, "crawledAt"[i] as "crawledAt", "firstSeenAt"[i] as "firstSeenAt"
        from rental_arrays, unnest(range(1, 1 + greatest(1, len("crawledAt"), coalesce(len("firstSeenAt"), 0)))) as u(i)""",
    "explode_row_growth": f"""{WITH} select count(*) as rows_in, cast(sum(n) as bigint) as rows_out,
        count(*) filter (where n = 0) as rows_lost
        from (select len("crawledAt") * coalesce(len("firstSeenAt"), 0) as n from rental_arrays)""",
    "rows_with_value": f"{WITH} select listing_id, bedrooms from listings where bedrooms = '3'",
    "listings_preview": f"{WITH} select * from listings order by listing_id limit 25",
    "columns_by_type": f"{WITH} select * from rentals",
    "distinct_coordinates": f"{WITH} select * from coordinates",
    "distinct_offers": f"""{WITH} select distinct "postalCode", "areaSqm" from rentals""",
    "geojson_polygons": f"""{WITH} select postcode, members, cast(5 as integer) as ring_size,
        round(mid_x + cast(dx as double), 6) as x, round(mid_y + cast(dy as double), 6) as y
        from areas join {_corners()} using (kind)""",
    "geojson_one_file": f"""{WITH} select postcode, members, cast(5 as integer) as ring_size,
        round(mid_x + cast(dx as double), 6) as x, round(mid_y + cast(dy as double), 6) as y
        from areas join {_corners()} using (kind)""",
    "csv_line_breaks": f"""{WITH} select listing_id::varchar as listing_id, nullif(zipcode, '') as zipcode, price,
        case listing_id % 4 when 0 then host_note || chr(10) || '"cosy", 2 rooms' when 1 then chr(10) || chr(10)
          else host_note end as host_note, false as corrupt from listings""",
    "geojson_inferred_schema": f"""{WITH} select postcode,
        case kind when 'boxes' then 'MultiPolygon' when 'point' then 'Point' else 'Polygon' end as kind,
        cast(case when kind = 'point' then null when kind in ('boxes', 'ring') then 10 else 5 end as integer) as positions
        from areas""",
    "geojson_lines": f"""{WITH} select postcode, round(min(mid_y + cast(dy as double)), 6) as bottom,
        round(max(mid_y + cast(dy as double)), 6) as top, round(min(mid_x + cast(dx as double)), 6) as left_side
        from areas join {_corners()} using (kind) group by owner, postcode""",
    "contains_test": f"""{WITH} select owner, {sql_inside('mid_x', 'mid_y')} as centre_inside,
        {sql_inside('(mid_x + cast(0.26 as double))', '(mid_y - cast(0.13 as double))')} as off_centre_inside
        from areas""",
    "point_in_polygon": f"{WITH} select * from pairs",
    "point_in_polygon_shuffled": f"{WITH} select * from pairs",
    "point_in_polygon_default_grid": f"{WITH} select * from pairs",
    "zipcode_fill": f"""{WITH} select listing_id, latitude, longitude, zipcode_formatted, postcode, final_zipcode
        from filled""",
    "zipcode_fill_first": FILLED_FIRST,
    "unmatched_coordinate_report": f"""{WITH} select latitude, longitude, postcode from missing
        left join located using (latitude, longitude)""",
    "zipcode_fill_profile": f"""{WITH},
        needy as (select * from formatted where zipcode_formatted is null),
        hits as (select latitude, longitude, count(*) as hits from located group by 1, 2),
        places as (select latitude, longitude, count(*) as n, any_value(hits) as hits from needy
          left join hits using (latitude, longitude) where latitude is not null and longitude is not null group by 1, 2)
        select (select count(*) from needy) as missing_listings,
          (select count(*) from needy where latitude is null or longitude is null) as unplaced_listings,
          count(*) as missing_coordinates, count(*) filter (where hits is null) as unlocated_coordinates,
          count(*) filter (where hits > 1) as shared_coordinates,
          cast(sum(case when hits is null then n else 0 end) as bigint) as unlocated_listings,
          cast(sum(n * coalesce(hits, 0)) as bigint) as located_rows from places""",
    "silver_listing_rows": f"{WITH} select * from silver_listings",
    "silver_listing_rows_deduped": f"""{WITH} select distinct latitude, longitude, zipcode,
        cast(bedrooms as double) as bedrooms, try_cast(review_scores_value as double) as review_scores_value,
        floor(cast(price as double) / 100000) as price, zipcode_formatted, postcode, final_zipcode,
        {_pc4('final_zipcode')} as postalcode4
        from filled where {_pc4('final_zipcode')} <> '' and try_cast(price as double) is not null""",
    "silver_rental_rows": f"{WITH} select * from silver_rentals",
    "gold_short_term_summary": f"{GOLD} select * from short_term",
    "gold_short_term_extremes": EXTREMES,
    "gold_long_term_summary": f"{GOLD} select * from long_term",
    "gold_investment_comparison": f"{GOLD} select * from comparison",
    "gold_comparison_other_economics": f"{_gold('0.7', 360, 11)} select * from comparison",
    "raw_files_to_gold": f"{GOLD} select * from comparison",
    "raw_files_to_gold_options": f"{OPTIONS} select * from comparison",
    # In whole 10^-14ths, rounded half up to hundredths: 10^12 of them.
    "gold_exact_tiny": f"""with tiny as (select {TINY['postalcode4']} as postalcode4, {TINY['price']} as price from orders),
        units as (select postalcode4, cast(split_part(price, '.', 1) as hugeint) * 100000000000000
          + cast(rpad(split_part(price, '.', 2), 14, '0') as hugeint) as u from tiny),
        sums as (select postalcode4, cast(sum(u) as hugeint) as u, count(*) as n from units group by 1)
        select postalcode4, cast((2 * u + n * cast(1000000000000 as hugeint)) // (2 * n * cast(1000000000000 as hugeint)) as double)
          / 100 as avg_nightly_price, n as airbnb_listing_count from sums""",
    "rentals_any_fields": ANY_FIELDS,
    "jobs_default_ingest": DEFAULT_INGEST,
    "exploded_in_pieces": f"""{WITH} select order_id, line_no, "crawledAt", "firstSeenAt" from exploded""",
    "run_report": RUN_REPORT,
    "global_rank_two_step": """select *, rank() over (order by price desc nulls last) as price_rank from (
        select l_orderkey, l_linenumber, l_suppkey, case when l_linenumber = 7 then null
          when l_linenumber = 6 then cast(1000 as double) else l_extendedprice end as price from lineitem)""",
    "quality_profile": f"""{WITH} select count(*) as row_count,
        count(*) filter (where zipcode is null) as zipcode_nulls,
        count(*) filter (where zipcode_formatted is null) as formatted_nulls,
        count(*) filter (where try_cast(price as double) is null) as price_unreadable,
        count(*) filter (where bedrooms = '3') as three_bedrooms,
        (select count(*) from coordinates) as distinct_coordinates from formatted""",
    "missing_coordinate_profile": f"{WITH} select count(*) as row_count from missing",
    "null_count_profile": f"""{WITH} select count(*) as row_count, count(*) filter (where zipcode is null) as zipcode_nulls,
        count(*) filter (where latitude is null) as latitude_nulls,
        count(*) filter (where review_scores_value is null) as review_scores_value_nulls from listings""",
    "csv_roundtrip": f"""{WITH} select listing_id::varchar as listing_id,
        {', '.join(f"nullif({c}, '') as {c}" for c in _TEXTS)} from listings""",
    "csv_with_schema": f"""{WITH} select listing_id::varchar as listing_id,
        {', '.join(f"nullif({c}, '') as {c}" for c in _TEXTS if c != 'host_note')}, false as corrupt from listings""",
    "json_roundtrip": f"{WITH} select * replace (cast(line_no as bigint) as line_no) from rental_arrays",
    "table_overwrite": f"""{WITH} select order_id, line_no, rent, cast(1 as integer) as columns_before,
        cast(3 as integer) as columns_after, cast(count(*) over () as integer) as rows_written from rentals""",
}
