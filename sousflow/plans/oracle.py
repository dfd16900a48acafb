"""DuckDB SQL for every registered query (the correctness oracle).

Each query is written from the job's definition, in its own shape: smallest ids by a filtered
window, distances between distinct places, the last event by ``arg_max``, rank positions by
counting, a day's winners from one grouped pass. It shares no code path with the Spark
jobs, only the bridge rules (``sousflow.sources.bridge``), restated here in SQL.
"""

from __future__ import annotations

from sousflow.functions.geo import EARTH_RADIUS_M, METRES_PER_MILE
from sousflow.sources import bridge as B


def floor_div_sql(x: str, n: int) -> str:
    return f"(({x}) - ((({x}) % {n}) + {n}) % {n}) // {n}"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"({2.0 * EARTH_RADIUS_M!r} * asin(sqrt(CASE WHEN {a} > 1.0 THEN 1.0 ELSE {a} END)))"


def _coord(k: str, mult: int, modulo: int, shift: int, frac: int) -> str:
    return f"CAST((({k} * {mult}) % {modulo} - {shift}) * 10000 + ({k} * {frac}) % 10000 AS DOUBLE) / CAST(10000 AS DOUBLE)"


def _place_name(block: str) -> str:
    return f"CASE WHEN {block} = 0 THEN n_name ELSE n_name || ' ' || CAST({block} AS VARCHAR) END"


_SECONDS = floor_div_sql("epoch_us(ts)", 1_000_000)
_EVENT = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in B.EVENT_NAMES.items()) + " ELSE event_type END"

BRIDGE = {
    "nations": """
        SELECT CAST(n.n_nationkey AS BIGINT) AS k, n.n_name, r.r_name
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "places": f"""
        SELECT place, name, r_name, {_coord('place', 37, 110, 55, 137)} AS lat, {_coord('place', 71, 340, 170, 291)} AS lon
        FROM (SELECT DISTINCT k + {B.NATIONS} * (c_custkey // {B.PLACE_CUSTOMERS}) AS place,
                     {_place_name(f"(c_custkey // {B.PLACE_CUSTOMERS})")} AS name, r_name
              FROM customer JOIN nations ON CAST(c_nationkey AS BIGINT) = k)""",
    "us_cities": f"""
        SELECT 2 * place AS city_id, name AS city_name, r_name AS state_abbr, lat, lon FROM places
        UNION ALL
        SELECT 2 * place + 1, '  ' || lower(name) || ' ', lower(r_name), lat, lon
        FROM places WHERE place % {B.DIRTY_CITY_EVERY} = 0""",
    "customer_data": f"""
        SELECT c_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name,
               lower(replace(c_name, '#', '.')) || '{B.EMAIL_DOMAIN}' AS email
        FROM customer""",
    "customer_address": f"""
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % {B.INELIGIBLE_CUSTOMER_EVERY} = 0 THEN '{B.UNKNOWN_CITY}'
                    WHEN c_custkey % 3 = 0 THEN name
                    WHEN c_custkey % 3 = 1 THEN lower(name)
                    ELSE '  ' || name || ' ' END AS customer_city,
               r_name AS customer_state
        FROM (SELECT c_custkey, r_name, {_place_name(f"(c_custkey // {B.PLACE_CUSTOMERS})")} AS name
              FROM customer JOIN nations ON CAST(c_nationkey AS BIGINT) = k)""",
    "supplier_info": f"""
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name,
               CASE WHEN k % {B.UNLOCATED_SUPPLIER_EVERY} = 0 THEN '{B.UNKNOWN_CITY}'
                    ELSE {_place_name(f"(s_suppkey // {B.PLACE_SUPPLIERS})")} END AS supplier_city,
               r_name AS supplier_state
        FROM supplier JOIN nations ON CAST(s_nationkey AS BIGINT) = k""",
    "type_tags": """
        SELECT p_type, CAST(min(p_partkey) AS BIGINT) AS tag_id FROM part GROUP BY p_type""",
    "recipe_tags": f"""
        SELECT tag_id, CASE WHEN p_type = '{B.MISSING_TAG_TYPE}' THEN '{B.MISSING_TEXT}' ELSE ' ' || p_type END AS tag_property
        FROM type_tags""",
    "customer_survey": f"""
        SELECT DISTINCT o.o_custkey AS customer_id, t.tag_id, (o.o_custkey % {B.INACTIVE_SURVEY_EVERY} <> 0) AS is_active
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey JOIN type_tags t ON t.p_type = p.p_type""",
    "recipe": """
        SELECT p_partkey AS recipe_id, p_name AS recipe_name,
               string_split(p_name, ' ') AS tag_list, string_split(p_name, ' ') AS ingredients
        FROM part""",
    "nutrition": """
        SELECT replace(p_name, ' ', ', ') AS ingredient_name, CAST(p_size AS BIGINT) AS calories,
               CAST(p_size AS VARCHAR) || 'g' AS total_fat
        FROM part""",
    "website_activity": f"""
        SELECT event_id,
               CAST(user_id AS VARCHAR) || '-' || CAST({floor_div_sql(_SECONDS, B.SESSION_BUCKET_SECONDS)} AS VARCHAR) AS session_id,
               user_id, ts AS event_timestamp,
               CAST(json_object('event', {_EVENT}, 'recipe_id', json_extract_string(props, '$.k')) AS VARCHAR) AS event_details
        FROM events""",
}


def _with(body: str, *ctes: tuple[str, str], bridge: bool = True) -> str:
    parts = [f"{name} AS ({sql})" for name, sql in BRIDGE.items()] if bridge else []
    parts += [f"{name} AS ({sql})" for name, sql in ctes]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


# Each named relation below is used by several queries; a query lists the ones it needs.
_KEYED_CITIES = ("keyed_cities", "SELECT *, trim(lower(city_name)) AS town, trim(upper(state_abbr)) AS region FROM us_cities")


def _one_per_city(strict: bool) -> tuple[str, str]:
    spelling = "town, region" if strict else "town, region, city_name, state_abbr"
    return ("one_per_city", f"SELECT * FROM keyed_cities QUALIFY city_id = min(city_id) OVER (PARTITION BY {spelling})")


def _housed(strict: bool) -> list[tuple[str, str]]:
    """Addresses in a known city, with the customer's names."""
    return [_KEYED_CITIES, _one_per_city(strict), ("housed", """
        SELECT home.customer_id, who.first_name, who.last_name, who.email, home.customer_city, home.customer_state, town.lat, town.lon
        FROM one_per_city town
        JOIN customer_address home ON town.town = trim(lower(home.customer_city)) AND town.region = trim(upper(home.customer_state))
        LEFT JOIN customer_data who USING (customer_id)""")]


def _nearest_shops(strict: bool) -> list[tuple[str, str]]:
    """For each home place the places of shops at its smallest distance."""
    return _housed(strict) + [
        ("shops", """SELECT supplier_id, supplier_name, lat, lon FROM supplier_info
                     JOIN one_per_city ON lower(city_name) = lower(supplier_city) AND upper(state_abbr) = supplier_state
                     WHERE lat IS NOT NULL AND lon IS NOT NULL"""),
        ("reach", f"""SELECT home.lat, home.lon, shop.lat AS shop_lat, shop.lon AS shop_lon,
                             {haversine_sql('home.lat', 'home.lon', 'shop.lat', 'shop.lon')} AS metres
                      FROM (SELECT DISTINCT lat, lon FROM housed) home, (SELECT DISTINCT lat, lon FROM shops) shop
                      WHERE home.lat IS NOT NULL AND home.lon IS NOT NULL
                      QUALIFY metres = min(metres) OVER (PARTITION BY home.lat, home.lon)"""),
        ("homes", """SELECT housed.*, (SELECT min(metres) FROM reach WHERE reach.lat = housed.lat AND reach.lon = housed.lon) AS metres FROM housed"""),
    ]


def _wishes(strict: bool = True, different: bool = False) -> list[tuple[str, str]]:
    """Position of each known tag of a housed customer: one more than the rows with a smaller tag."""
    counted = "1" if different else "count(*)"
    return _housed(strict) + [
        ("tag_counts", f"""SELECT customer_id, trim(lower(tag_property)) AS tag, {counted} AS n FROM customer_survey JOIN recipe_tags USING (tag_id)
                          WHERE tag_property <> '<NA>' GROUP BY customer_id, tag"""),
        ("people", f"""SELECT customer_id, first_name, last_name, email, {"1" if different else "sum(count(*)) OVER (PARTITION BY customer_id)"} AS copies
                      FROM housed GROUP BY customer_id, first_name, last_name, email"""),
        ("placed_tags", """SELECT this.customer_id, this.tag, coalesce(sum(less.n), 0) AS rows_before
                           FROM tag_counts this LEFT JOIN tag_counts less ON less.customer_id = this.customer_id AND less.tag < this.tag
                           GROUP BY this.customer_id, this.tag"""),
        ("wishes", """SELECT people.customer_id, first_name, last_name, email,
                             min(tag) FILTER (WHERE rows_before * copies = 0) AS food_preference_1,
                             min(tag) FILTER (WHERE rows_before * copies = 1) AS food_preference_2,
                             min(tag) FILTER (WHERE rows_before * copies = 2) AS food_preference_3
                      FROM people JOIN placed_tags USING (customer_id) GROUP BY ALL"""),
    ]


_TAG_MENU = ("tag_menu", """SELECT trim(lower(tag)) AS recipe_tag_cleaned, arg_max(recipe_name, recipe_id) AS recipe_name
                            FROM (SELECT recipe_id, recipe_name, unnest(tag_list) AS tag FROM recipe) GROUP BY recipe_tag_cleaned""")
_ACTIVE = ("active", "SELECT customer_id, count(*) AS food_pref_count FROM customer_survey WHERE is_active GROUP BY customer_id")

BRIDGE_RULE_SQL = """(customer_state = 'AFRICA' AND (trim(city_name) ILIKE '%nation_1%' OR trim(city_name) ILIKE '%nation_5'))
                  OR (customer_state = 'ASIA' AND trim(city_name) ILIKE '%2%')"""

_HIT = [_KEYED_CITIES, _ACTIVE, ("hit", f"""
        SELECT customer_id, first_name, last_name, customer_city, customer_state, food_pref_count, lat, lon
        FROM keyed_cities, customer_address JOIN customer_data USING (customer_id) JOIN active USING (customer_id)
        WHERE town = trim(lower(customer_city)) AND region = trim(upper(customer_state)) AND ({BRIDGE_RULE_SQL})""")]

_ACTS = ("acts", """SELECT event_id, session_id, event_timestamp, j ->> '$.event' AS event, j ->> '$.recipe_id' AS recipe_id
                    FROM (SELECT *, CASE WHEN json_valid(event_details) THEN CAST(event_details AS JSON) END AS j FROM website_activity)""")
#: One row per session, NULL session ids together.
_VISITS = [_ACTS, ("visits", """
        SELECT session_id, CAST(min(event_timestamp) AS DATE) AS session_date,
               arg_max({'event': event, 'recipe': recipe_id}, (event_timestamp, event_id)) AS final,
               count(*) FILTER (WHERE event = 'search') AS searches, count(*) FILTER (WHERE event = 'view_recipe') AS views,
               """ + floor_div_sql("epoch_us(max(event_timestamp))", 1_000_000) + " - " + floor_div_sql("epoch_us(min(event_timestamp))", 1_000_000) + """ AS seconds
        FROM acts GROUP BY session_id""")]
#: Views of the sessions that end on one, by day and the recipe of the last event; top of the day.
_DAY_TOPS = _VISITS + [("day_tops", """
        SELECT session_date, final.recipe AS recipe_id FROM visits WHERE final.event = 'view_recipe'
        GROUP BY session_date, final.recipe QUALIFY sum(views) = max(sum(views)) OVER (PARTITION BY session_date)""")]
_DAYS = """SELECT session_date, count(session_id) AS num_sessions, avg(seconds) AS avg_session_length_seconds,
                  avg(searches) FILTER (WHERE final.event = 'view_recipe') AS avg_num_searches_before_viewing_recipe
           FROM visits GROUP BY session_date"""


def _shop_places(strict: bool) -> list[tuple[str, str]]:
    """Located suppliers, and each place with the other places at its smallest distance."""
    return [_KEYED_CITIES, _one_per_city(strict),
        ("spots", """SELECT supplier_id, supplier_city || ', ' || supplier_state AS spot, lat, lon FROM supplier_info
                     JOIN one_per_city ON trim(upper(city_name)) = trim(upper(supplier_city)) AND region = trim(upper(supplier_state))"""),
        ("others", f"""SELECT a.lat, a.lon, b.lat AS other_lat, b.lon AS other_lon, {haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS metres
                       FROM (SELECT DISTINCT lat, lon FROM spots) a, (SELECT DISTINCT lat, lon FROM spots) b
                       WHERE metres > 0 QUALIFY metres = min(metres) OVER (PARTITION BY a.lat, a.lon)"""),
        ("mains", """SELECT spots.*, others.* EXCLUDE (lat, lon) FROM spots JOIN others USING (lat, lon)
                     QUALIFY metres = min(metres) OVER (PARTITION BY supplier_id)"""),
    ]


def oracle_queries(bridge: bool = True) -> dict[str, str]:
    """SQL per query name. ``bridge=False`` reads business tables of those names
    directly (fixtures registered in DuckDB) instead of deriving them."""
    def with_bridge(body: str, *ctes: tuple[str, str]) -> str:
        return _with(body, *ctes, bridge=bridge)

    q: dict[str, str] = {}
    q["preview_limit"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation ORDER BY n_nationkey LIMIT 4"
    q["clean_keys"] = with_bridge("""
        SELECT customer_id, customer_city, customer_state,
               trim(lower(customer_city)) AS customer_city_cleaned, trim(upper(customer_state)) AS customer_state_cleaned
        FROM customer_address""")
    q["city_profile"] = with_bridge("""
        SELECT count(DISTINCT trim(lower(city_name))) AS num_city_names,
               count(DISTINCT trim(upper(state_abbr))) AS num_state_abbrs,
               count(DISTINCT city_id) AS num_city_ids
        FROM us_cities""")
    q["duplicate_cities"] = with_bridge("""
        SELECT trim(lower(city_name)) AS city_name_cleaned, trim(upper(state_abbr)) AS state_abbr_cleaned,
               count(city_id) AS num_cities
        FROM us_cities GROUP BY ALL HAVING count(city_id) > 1""")
    for key, strict in (("canonical_cities", False), ("canonical_cities_strict", True)):
        q[key] = with_bridge("""SELECT city_id, city_name, state_abbr, town AS city_name_cleaned, region AS state_abbr_cleaned, lat, lon
                                FROM one_per_city""", _KEYED_CITIES, _one_per_city(strict))
    q["customer_city_left"] = with_bridge("""
        SELECT home.customer_id, first_name, last_name, customer_city, customer_state, lat, lon
        FROM keyed_cities RIGHT JOIN customer_address home ON town = trim(lower(customer_city)) AND region = trim(upper(customer_state))
        LEFT JOIN customer_data who ON who.customer_id = home.customer_id""", _KEYED_CITIES)
    q["eligible_customers"] = with_bridge("SELECT * FROM housed", *_housed(True))
    q["eligible_customers_parity"] = with_bridge("SELECT * FROM housed", *_housed(False))
    for key, strict in (("nearest_supplier", True), ("nearest_supplier_parity", False)):
        q[key] = with_bridge("""
        SELECT customer_id, first_name, last_name, email, supplier_id, supplier_name, round(best.metres / 1000, 3) AS shipping_distance_km
        FROM (SELECT * FROM homes QUALIFY metres IS NOT DISTINCT FROM min(metres) OVER (PARTITION BY customer_id)) best
        LEFT JOIN reach ON reach.lat = best.lat AND reach.lon = best.lon
        LEFT JOIN shops ON shops.lat = shop_lat AND shops.lon = shop_lon""", *_nearest_shops(strict))
    q["top3_preferences"] = with_bridge("SELECT * FROM wishes", *_wishes())
    q["top3_preferences_parity"] = with_bridge("SELECT * FROM wishes", *_wishes(False))
    q["top3_preferences_distinct"] = with_bridge("SELECT * FROM wishes", *_wishes(different=True))
    q["recipe_index"] = with_bridge("SELECT * FROM tag_menu", _TAG_MENU)
    q["recipe_suggestion"] = with_bridge("""
        SELECT wishes.*, recipe_tag_cleaned, recipe_name FROM wishes LEFT JOIN tag_menu ON recipe_tag_cleaned = food_preference_1""",
        *_wishes(), _TAG_MENU)
    q["active_pref_count"] = with_bridge("SELECT * FROM active", _ACTIVE)
    q["impacted_customers"] = with_bridge("SELECT * FROM hit", *_HIT)
    mile = METRES_PER_MILE
    (chicago, chicago_state), (gary, gary_state) = B.BRIDGE_STORES["chicago"], B.BRIDGE_STORES["gary"]

    def miles(store: str) -> str:
        return f"CAST(round({haversine_sql('hit.lat', 'hit.lon', f'{store}.lat', f'{store}.lon')} / {mile}) AS INTEGER)"

    q["store_distances"] = with_bridge(f"""
        SELECT first_name || ' ' || last_name AS customer_name, customer_city, customer_state, food_pref_count,
               {miles('north')} AS chicago_distance_miles, {miles('east')} AS gary_distance_miles
        FROM hit
        JOIN us_cities north ON north.city_name = '{chicago}' AND north.state_abbr = '{chicago_state}'
        JOIN us_cities east ON east.city_name = '{gary}' AND east.state_abbr = '{gary_state}'""", *_HIT)
    names = ", ".join(f"'{n}'" for n in B.BRIDGE_RECIPES)
    grams = "CAST(round(TRY_CAST(replace({}, 'g', '') AS DECIMAL(38, 6))) AS INTEGER)"
    for key, fat, total in (("recipe_nutrition", "max(total_fat)", f"sum({grams.format('fat')})"),
                            ("recipe_nutrition_numeric", f"max({grams.format('total_fat')})", "sum(fat)")):
        q[key] = with_bridge(f"""
        SELECT recipe_name, CAST(sum(calories) AS BIGINT) AS total_calories, CAST({total} AS BIGINT) AS total_fat
        FROM (SELECT recipe_name, unnest(ingredients) AS item FROM recipe WHERE recipe_name IN ({names}))
        LEFT JOIN facts ON food = trim(upper(replace(item, '"', ''))) GROUP BY recipe_name""",
            ("facts", f"""SELECT trim(upper(CASE WHEN contains(ingredient_name, ',') THEN split_part(ingredient_name, ',', 1)
                                            WHEN ingredient_name IS NOT NULL THEN '' END)) AS food,
                                 max(calories) AS calories, {fat} AS fat FROM nutrition GROUP BY food"""))
    q["flatten_index"] = with_bridge("""
        SELECT recipe_id, CAST(generate_subscripts(ingredients, 1) - 1 AS INTEGER) AS ingredient_index, unnest(ingredients) AS ingredient
        FROM recipe""")
    for key, strict in (("backup_supplier", True), ("backup_supplier_parity", False)):
        q[key] = with_bridge(f"""
        SELECT who.supplier_id, who.supplier_name, mains.spot AS location_main, back.spot AS location_backup,
               round(mains.metres / {mile}) AS travel_miles
        FROM mains JOIN spots back ON back.lat = other_lat AND back.lon = other_lon
        JOIN supplier_info who ON who.supplier_id = mains.supplier_id""", *_shop_places(strict))
    q["supplier_places"] = with_bridge("""
        SELECT supplier_id, supplier_name, supplier_city || ', ' || supplier_state AS supplier_location, lat, lon
        FROM supplier_info JOIN one_per_city ON trim(upper(city_name)) = trim(upper(supplier_city)) AND region = trim(upper(supplier_state))""",
        *_shop_places(True))
    q["json_path_filter"] = with_bridge("SELECT event_id, session_id, event_timestamp, recipe_id FROM acts WHERE event = 'view_recipe'", _ACTS)
    q["window_min_last"] = with_bridge("""
        SELECT event_id, acts.session_id, event_timestamp, session_date, final.event AS last_event, final.recipe AS last_recipe_id
        FROM acts JOIN visits ON visits.session_id IS NOT DISTINCT FROM acts.session_id""", *_VISITS)
    q["session_summary"] = with_bridge("""
        SELECT session_date, session_id, coalesce(final.event = 'view_recipe', false) AS has_viewed_recipe,
               searches AS num_searches, CAST(seconds AS BIGINT) AS session_length FROM visits""", *_VISITS)
    q["most_viewed_daily"] = with_bridge("SELECT * FROM day_tops", *_DAY_TOPS)
    q["daily_sessions"] = with_bridge(_DAYS, *_VISITS)
    q["daily_report"] = with_bridge(f"""
        SELECT *, replace(coalesce((SELECT string_agg(recipe_id, ', ' ORDER BY recipe_id) FROM day_tops
                                    WHERE day_tops.session_date IS NOT DISTINCT FROM days.session_date), ''), '"', '') AS most_viewed_recipe
        FROM ({_DAYS}) days WHERE avg_session_length_seconds > 0""", *_DAY_TOPS)
    ordered = {"us_cities": "city_id", "customer_data": "customer_id", "customer_address": "customer_id", "supplier_info": "supplier_id",
               "customer_survey": "customer_id, tag_id", "recipe_tags": "tag_id", "nutrition": "ingredient_name, calories", "website_activity": "event_id"}
    for name, order in ordered.items():
        q[f"preview_{name}"] = with_bridge(f"SELECT * FROM {name} ORDER BY {order} LIMIT 4")
    q["preview_recipe"] = with_bridge("""
        SELECT * REPLACE (array_to_string(tag_list, ',') AS tag_list, array_to_string(ingredients, ',') AS ingredients)
        FROM recipe ORDER BY recipe_id LIMIT 4""")
    return q
