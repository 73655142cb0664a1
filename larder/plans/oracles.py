"""SQL twins of the registered queries (ANSI SQL as DuckDB runs it).

Expected values come from the star-schema columns; rendered text is not read,
except for the queries over the raw ``pages`` table.
"""

from __future__ import annotations

from larder.plans.views import IMAGE_HOST, MARKET, SECOND

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"

# One row per lineitem row, with name, amount and unit.
LINES = """
lp0 AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
         l.l_returnflag, l.l_linestatus, CAST(l.l_quantity AS BIGINT) AS q,
         replace(replace(p.p_name, 'small', 'green'), 'large', 'amber') AS name,
         CASE WHEN l.l_linenumber <= 2 THEN l.l_quantity / 4 ELSE l.l_quantity END AS amount
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
lp1 AS (
  SELECT *,
         CASE l_linenumber WHEN 1 THEN 'cup' WHEN 2 THEN 'tablespoon' WHEN 3 THEN 'ounce'
              WHEN 4 THEN 'gram' WHEN 5 THEN 'pinch' WHEN 6 THEN 'pound' END AS unit,
         name || CASE WHEN amount > 1 THEN 's' ELSE '' END AS noun,
         CASE WHEN l_linenumber > 2 THEN CAST(q AS VARCHAR)
              ELSE trim(CASE WHEN q // 4 > 0 THEN CAST(q // 4 AS VARCHAR) ELSE '' END
                || CASE WHEN q % 4 > 0 THEN ' ' || CAST(q % 4 AS VARCHAR) || '/4' ELSE '' END) END AS amount_text
  FROM lp0),
lp AS (
  SELECT *,
         amount_text || CASE WHEN unit IS NULL THEN ''
           ELSE ' ' || unit || CASE WHEN amount > 1 THEN CASE unit WHEN 'pinch' THEN 'es' ELSE 's' END ELSE '' END END
           || ' ' || noun AS line,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                            l_extendedprice, l_returnflag, l_linestatus) AS pos
  FROM lp1)"""

# One row per order, with the row-level facts of its recipe.
FACTS = """
facts AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, c_nationkey,
         'www.site' || c_nationkey || '.example' AS domain,
         'recipes/' || o_orderkey || '.html' AS path,
         'Serves ' || (o_orderkey % 12 + 1) AS servings,
         (o_custkey % 60) || ' minutes' AS prep_time,
         CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 90 + 1) || ' minutes' END AS cook_time,
         c_name || CASE WHEN o_orderkey % 11 = 0 THEN chr(10) || 'Guest Cook' ELSE '' END AS author,
         CASE WHEN o_orderkey % 9 <> 0 THEN 'Made by ' || c_name || '.' || chr(10) || 'Keeps well.' END AS description,
         CASE WHEN o_custkey % 5 > 0 AND o_orderkey % 5 > 0 THEN (o_orderkey % 5) / 4.0::DOUBLE END AS rating,
         CASE WHEN o_custkey % 5 > 0 AND o_orderkey % 101 > 0 THEN round((o_orderkey % 101) * 0.01::DOUBLE, 2) END AS make_again,
         CASE WHEN o_custkey % 5 > 0 THEN o_custkey % 5 END AS ratings,
         CASE WHEN o_orderkey % 13 <> 0 THEN '{host}' || o_orderkey || '.jpg' END AS image_url,
         'recipes%2F' || o_orderkey || '.html.jpg' AS image_file
  FROM orders JOIN customer ON o_custkey = c_custkey)""".replace("{host}", IMAGE_HOST)

# Recipes with title and counts (NULL counts where the order has no lines).
RECIPES = f"""{LINES},{FACTS},
per_order AS (
  SELECT l_orderkey, arg_min(name, pos) AS first_name, count(*) AS n_lines,
         count(DISTINCT l_returnflag) AS n_parts
  FROM lp GROUP BY l_orderkey),
recipes AS (
  SELECT f.*, CASE WHEN o_orderkey % 97 <> 0 THEN first_name || ' pie' END AS title, n_lines, n_parts
  FROM facts f LEFT JOIN per_order ON l_orderkey = o_orderkey)"""


def analytics() -> dict[str, str]:
    w = f"WITH {RECIPES}"
    out = {
        "a1_preview": f"{w} SELECT domain, path, title FROM recipes ORDER BY domain, path LIMIT 5",
        "a2_row_count": "SELECT count(*) AS rows FROM orders",
        "a3_missing_titles": f"{w} SELECT domain, path FROM recipes WHERE title IS NULL",
        "a4_drop_missing": f"{w} SELECT path, title FROM recipes WHERE title IS NOT NULL AND n_lines IS NOT NULL",
        "a5_reindex": f"{w} SELECT row_number() OVER (ORDER BY domain, path) - 1 AS row_index, domain, path "
                      "FROM recipes WHERE title IS NOT NULL AND n_lines IS NOT NULL",
        "a6_title_value_counts": f"{w} SELECT title, count(*) AS n FROM recipes WHERE title IS NOT NULL "
                                 "GROUP BY title ORDER BY n DESC, title LIMIT 10",
        "a7_title_equals": f"{w} SELECT domain, path, title FROM recipes WHERE title = 'blue bolt pie'",
        "a8_part_count": f"{w} SELECT CAST(n_parts AS INTEGER) AS parts, count(*) AS n FROM recipes "
                         "WHERE n_lines IS NOT NULL GROUP BY 1",
        "a9_ingredient_count": f"{w} SELECT path, CAST(n_lines AS INTEGER) AS ingredient_count FROM recipes "
                               "WHERE n_lines IS NOT NULL",
        "a10_mean_ingredient_count": f"{w} SELECT avg(n_lines) AS mean_count FROM recipes",
        "a11_site_url": f"{w} SELECT path, 'https://' || domain || '/recipes/' || o_orderkey AS url FROM recipes",
        "a12_histogram": f"""{w}, lim AS (
            SELECT min(n_lines)::DOUBLE AS lo, max(n_lines)::DOUBLE AS hi, count(n_lines) AS total FROM recipes),
          bins AS (SELECT b.range AS bin FROM range(50) b),
          hit AS (SELECT least(CAST(floor((n_lines - lo) / ((hi - lo) / 50)) AS BIGINT), 49) AS bin, count(*) AS n
                  FROM recipes, lim WHERE n_lines IS NOT NULL GROUP BY 1)
          SELECT bins.bin, round(lo + bins.bin * ((hi - lo) / 50), 9) AS left_edge, coalesce(n, 0) AS n,
                 round(coalesce(n, 0) / (total * ((hi - lo) / 50)), 9) AS density
          FROM bins CROSS JOIN lim LEFT JOIN hit ON hit.bin = bins.bin""",
        "a13_title_variants": f"""{w}, body AS (
            SELECT l_orderkey,
                   string_agg(l_returnflag || ':' || line, '|' ORDER BY l_returnflag, pos) AS ing,
                   string_agg(l_linestatus || ':' || name, '|' ORDER BY l_linestatus, pos) AS ins
            FROM lp GROUP BY l_orderkey)
          SELECT title, count(*) AS recipes, count(DISTINCT ing) AS distinct_ingredients,
                 count(DISTINCT ins) AS distinct_instructions
          FROM recipes JOIN body ON l_orderkey = o_orderkey WHERE title IS NOT NULL
          GROUP BY title HAVING count(*) > 1""",
    }
    return out


# --- urls and links ------------------------------------------------------------

URL_PARTS = """
url_parts AS (
  SELECT page_id, url, html,
         split_part(url, '://', 1) AS scheme,
         split_part(split_part(url, '://', 2), '/', 1) AS domain,
         substr(split_part(url, '://', 2), length(split_part(split_part(url, '://', 2), '/', 1)) + 1) AS path
  FROM pages)"""

UNESCAPE = (
    "replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), "
    "'&#x27;', chr(39)), '&amp;', '&')"
)

# One row per anchor of the rendered site; hrefs as their parts, not as text.
SITE_LINKS = f"""
edges AS (
  SELECT '/' AS src, '/r/' || r_regionkey AS dst FROM region
  UNION ALL SELECT '/r/' || n_regionkey, '/n/' || n_nationkey FROM nation
  UNION ALL SELECT '/n/' || c_nationkey, '/c/' || c_custkey FROM customer
  UNION ALL SELECT '/c/' || o_custkey, '/o/' || o_orderkey FROM orders
  UNION ALL SELECT '/o/' || o_orderkey, '/n/' || c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey),
forms(pre, single, hidden, domain, path_pre, failed) AS (VALUES
  ('https://other.example/x/', true, false, 'other.example', '/x/', false),
  ('/hid/', true, true, NULL, '/hid/', false),
  ('/go?u=http://z/', true, false, NULL, '/go?u=http://z/', false),
  ('/' || repeat('l', 121) || '/', true, false, NULL, '/' || repeat('l', 121) || '/', false),
  ('//x', true, false, NULL, NULL, true),
  ('/s/', true, false, NULL, '/s/', false),
  ('/two/', false, false, NULL, '/two/', false),
  ('/private/', true, false, NULL, '/private/', false),
  ('/o/../', true, false, NULL, '/o/../', false),
  ('https://www.market.example/abs/', true, false, '{MARKET}', '/abs/', false),
  ('rel/', true, false, NULL, '/rel/', false)),
site_links AS (
  SELECT src, dst AS href, true AS single, false AS hidden, NULL::VARCHAR AS domain, dst AS path, false AS failed FROM edges
  UNION ALL
  SELECT '/c/' || c_custkey, pre || c_custkey, single, hidden, domain, path_pre || c_custkey, failed
  FROM customer, forms WHERE c_custkey % 7 = 0),
usable AS (SELECT * FROM site_links WHERE single AND NOT hidden),
crawl_state AS (
  SELECT '{MARKET}' AS domain, '/o/' || o_orderkey AS path,
         CASE WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'P' THEN 'errored'
              WHEN o_orderkey % 5 = 0 THEN 'to_scrape' WHEN o_orderkey % 5 = 1 THEN 'in_progress' END AS state
  FROM orders),
seen AS (SELECT domain, path FROM crawl_state WHERE state IN ('finished', 'errored', 'to_scrape'))"""


def url_and_link() -> dict[str, str]:
    u, s = f"WITH {URL_PARTS}", f"WITH {SITE_LINKS}"
    bare = "CASE WHEN length(path) > 1 THEN {x} END"
    return {
        "s3_stored_file_key": f"""{u}, p AS (
            SELECT page_id, CASE WHEN length(path) > 1 THEN ltrim(path, '/') ELSE url END AS path FROM url_parts)
          SELECT page_id, url_encode(path) || '.html' AS file_name, path FROM p""",
        "l1_url_parts": f"""{u} SELECT page_id, {bare.format(x='scheme')} AS scheme, {bare.format(x='domain')} AS domain,
            CASE WHEN length(path) > 1 THEN path ELSE '/' || url END AS path FROM url_parts""",
        "l2_seed_base_url": f"{u} SELECT page_id, scheme || '://' || domain AS base_url FROM url_parts WHERE length(path) > 1",
        "l3_page_links": """SELECT page_id, CAST(generate_subscripts(h, 1) - 1 AS INTEGER) AS pos, unnest(h) AS href
            FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS h FROM pages)""",
        "l3_allowed_links": f"""{s} SELECT src, href FROM site_links, (VALUES ('/o/'), ('/s/'), ('o/../'), ('two/')) w(word)
            WHERE contains(href, word)""",
        "l4_resolve_href": f"""{u}, p AS (SELECT * FROM url_parts WHERE length(path) > 1), f AS (
            SELECT page_id, 0 AS form, domain, path, false AS failed FROM p
            UNION ALL SELECT page_id, 1, domain, path, false FROM p
            UNION ALL SELECT page_id, 2, NULL, path, false FROM p
            UNION ALL SELECT page_id, 3, NULL, path, false FROM p
            UNION ALL SELECT page_id, 4, NULL, path, false FROM p
            UNION ALL SELECT page_id, 5, NULL, NULL, true FROM p)
          SELECT * FROM f""",
        "l5_same_domain": f"""{u} SELECT page_id, length(path) <= 1 OR domain IN (
            'ththhe.example.com', 'www.ththhe.example.com', 'www.www.ththhe.example.com') AS internal FROM url_parts""",
        "l6_visible_links": f"{s} SELECT src, href FROM usable",
        "l7_avoided_links": f"{s} SELECT src, path FROM usable WHERE path IS NOT NULL AND NOT contains(path, 'private')",
        "l8_tidy_paths": f"{s} SELECT src, path FROM usable WHERE length(path) <= 120 AND NOT contains(path, 'http')",
        "l9_unseen_links": f"""{s} SELECT DISTINCT coalesce(domain, '{MARKET}') AS domain, path FROM usable
            WHERE NOT failed AND (coalesce(domain, '{MARKET}'), path) NOT IN (SELECT (domain, path) FROM seen)""",
        "l10_admitted_links": f"""{s} SELECT DISTINCT '{MARKET}' AS domain, path FROM usable
            WHERE NOT failed AND coalesce(domain, '{MARKET}') = '{MARKET}' AND length(path) <= 120
              AND NOT contains(path, 'http') AND NOT contains(path, 'private')
              AND path NOT IN (SELECT path FROM seen)""",
    }


# --- crawl sets --------------------------------------------------------------------

SITE = """
site(path, depth, scrapable, moved) AS (
  SELECT '/', 0, false, NULL
  UNION ALL SELECT '/r/' || r_regionkey, 1, false, NULL FROM region
  UNION ALL SELECT '/n/' || n_nationkey, 2, false, NULL FROM nation
  UNION ALL SELECT '/c/' || c_custkey, 3, false, CASE WHEN c_custkey % 10 = 0 THEN '/member/' || c_custkey END FROM customer
  UNION ALL SELECT '/o/' || o_orderkey, 4, o_orderstatus = 'F', NULL FROM orders),
lost(path, depth) AS (SELECT '/lost/' || r_regionkey, 2 FROM region)"""

LISTING = """
numbered AS (SELECT DISTINCT o_orderkey // 10 + 1 AS page_no FROM orders),
lim AS (SELECT CAST(ceil(max(page_no) / 2) AS BIGINT) AS sentinel, max(page_no) AS last FROM numbered),
scan AS (
  SELECT n.range AS page_no, n.range % 3 = 1 AND n.range <= last AS seen, n.range > last AS absent, sentinel
  FROM range(1, (SELECT max(page_no) FROM numbered) + 1) n, lim)"""


def crawl() -> dict[str, str]:
    s = f"WITH {SITE_LINKS},{SITE}"
    closure = "WITH RECURSIVE " + SITE_LINKS + "," + SITE + """,
      all_edges AS (SELECT src, dst FROM edges UNION ALL SELECT '/r/' || r_regionkey, '/lost/' || r_regionkey FROM region),
      walk(path) AS ({seed} UNION SELECT dst FROM walk JOIN all_edges ON src = walk.path)"""
    from_root = closure.replace("{seed}", "SELECT '/'")
    states = """, st AS (
        SELECT w.path, coalesce(s.depth, 2) AS depth,
               CASE WHEN s.path IS NULL THEN 'errored' ELSE 'finished' END AS state
        FROM walk w LEFT JOIN site s ON s.path = w.path),
      ranked AS (SELECT *, row_number() OVER (ORDER BY depth, path) AS position FROM st)"""
    # both sites by kind of page; every page that is linked to, with the page that links to it
    sites = "WITH RECURSIVE " + SITE_LINKS + "," + SITE + f""",
      hosts(host) AS (VALUES ('{MARKET}'), ('{SECOND}')),
      held AS (SELECT host, path, scrapable FROM site, hosts WHERE host = '{MARKET}' OR path NOT LIKE '/c/%' OR path[4:]::BIGINT % 5 <> 0),
      admitted AS (
        SELECT host, u.src, u.path AS dst FROM usable u JOIN held h ON h.path = u.src
        WHERE NOT failed AND coalesce(u.domain, host) = host AND length(u.path) <= 120 AND NOT contains(u.path, 'http') AND NOT contains(u.path, 'private')),
      walk(host, path) AS (SELECT host, '/' FROM hosts UNION SELECT a.host, a.dst FROM walk w JOIN admitted a ON a.host = w.host AND a.src = w.path),
      ends AS (
        SELECT w.host AS domain, w.path, coalesce(s.depth, 4) AS depth,
               CASE WHEN h.path IS NULL THEN 'errored' WHEN h.scrapable THEN 'to_scrape' ELSE 'finished' END AS state
        FROM walk w LEFT JOIN held h ON h.host = w.host AND h.path = w.path LEFT JOIN site s ON s.path = w.path)"""
    return {
        "f1_crawl_pages": sites + " SELECT domain, path, depth, state FROM ends",
        "f2_limit_by_site": sites + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY depth, path) AS position FROM ends),
          lasts AS (SELECT domain, min(position) AS last FROM ranked WHERE position >= 1000 AND state <> 'errored' GROUP BY domain)
          SELECT domain, path, depth, state, position FROM ranked LEFT JOIN lasts USING (domain) WHERE position <= coalesce(last, position)""",
        "f1_reachable": from_root + " SELECT w.path, coalesce(s.depth, 2) AS depth FROM walk w LEFT JOIN site s ON s.path = w.path",
        "f1_reachable_from_two": closure.replace("{seed}", "SELECT '/n/3' UNION SELECT '/r/1'")
        .replace(" UNION ALL SELECT '/r/' || r_regionkey, '/lost/' || r_regionkey FROM region", "")
        + " SELECT path FROM walk",
        "f2_page_limit": from_root + states + """ SELECT path, depth, state, position FROM ranked
            WHERE position <= (SELECT min(position) FROM ranked WHERE position >= 1000 AND state <> 'errored')""",
        "f3_set_union": f"""{s} SELECT path FROM site UNION
            SELECT path FROM crawl_state WHERE state IN ('in_progress', 'to_scrape')""",
        "f4_set_difference": f"{s} SELECT path FROM site EXCEPT SELECT path FROM crawl_state WHERE state = 'finished'",
        "f5_state_sizes": f"{s} SELECT domain, state, count(*) AS n FROM crawl_state WHERE state IS NOT NULL GROUP BY 1, 2",
        "f5_membership": f"{s} SELECT path FROM site INTERSECT SELECT path FROM crawl_state WHERE state = 'errored'",
        "f6_page_states": f"""{s} SELECT path, CASE WHEN scrapable THEN 'to_scrape' ELSE 'finished' END AS state FROM site
            UNION ALL SELECT path, 'errored' FROM lost""",
        "f7_redirects": f"""{s} SELECT coalesce(moved, path) AS path, 'in_progress' AS state FROM site
            UNION ALL SELECT path, 'finished' FROM site WHERE moved IS NOT NULL""",
        "f7_reach_redirected": f"{s} SELECT coalesce(moved, path) AS path FROM site",
        "f8_classify_by_path": f"""WITH {URL_PARTS} SELECT page_id,
            regexp_matches(CASE WHEN length(path) > 1 THEN path ELSE '/' || url END, '/en/[0-9]', 'i') AS scrapable FROM url_parts""",
        "f9_classify_by_element": f"{s} SELECT path, scrapable FROM site",
        "f10_listing_scan": f"""WITH {LISTING} SELECT page_no, CASE WHEN absent THEN 'errored' ELSE 'finished' END AS state
            FROM scan WHERE NOT seen AND page_no < sentinel""",
        "f10_listing_ranges": f"""WITH {LISTING}, held AS (
            SELECT CASE page_no WHEN 5 THEN 1000000000000 ELSE page_no END AS page_no FROM numbered WHERE page_no // 100 % 3 <> 1),
          old AS (SELECT page_no FROM numbered WHERE page_no % 3 = 1 AND page_no <= 10),
          every AS (SELECT page_no, page_no IN (SELECT page_no FROM old) AS seen FROM (SELECT page_no FROM held UNION SELECT page_no FROM old)),
          spaced AS (SELECT *, lag(page_no, 1, 0) OVER (ORDER BY page_no) AS previous FROM every)
          SELECT page_no, page_no AS to_page, 'finished' AS state FROM spaced WHERE NOT seen
          UNION ALL SELECT previous + 1, page_no - 1, 'errored' FROM spaced WHERE previous < page_no - 1""",
        "f11_drain": f"{s} SELECT path, 'finished' AS state FROM crawl_state WHERE state = 'in_progress'",
        "f12_early_stop": f"""WITH {LISTING}, met AS (
            SELECT *, coalesce(sum(CAST(seen AS INTEGER)) OVER (
              ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM scan)
          SELECT page_no, CASE WHEN absent THEN 'errored' ELSE 'finished' END AS state
          FROM met WHERE NOT seen AND page_no < sentinel AND before < 20""",
        "f13_resume": f"{s} SELECT path FROM crawl_state WHERE state = 'in_progress'",
    }


# --- pages and recipes ---------------------------------------------------------------

GROUPS = f"""{LINES}, grouped AS (
  SELECT 'recipes/' || l_orderkey || '.html' AS path, l_returnflag, l_linestatus, line, name,
         CAST(dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) - 1 AS INTEGER) AS flag_pos,
         CAST(dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_linestatus) - 1 AS INTEGER) AS status_pos,
         CAST(row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY pos) - 1 AS INTEGER) AS in_flag,
         CAST(row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY pos) - 1 AS INTEGER) AS in_status
  FROM lp)"""


def html_and_recipes() -> dict[str, str]:
    w, f = f"WITH {RECIPES}", f"WITH {FACTS}"
    tags = {"a": "<a ", "li": "<li>", "h1": "<h1>", "article": "<article>", "footer": "<footer>",
            "title": "<title>", "script": "<script>"}
    counts = " UNION ALL ".join(
        f"SELECT page_id, '{t}' AS tag, (length(html) - length(replace(html, '{m}', ''))) // {len(m)} AS n FROM pages"
        for t, m in tags.items()
    )
    location = "CASE WHEN image_url IS NOT NULL AND o_orderkey % 3 = 0 THEN 'images/' || image_file END"
    label = UNESCAPE.replace("{x}", "label")
    title = UNESCAPE.replace("{x}", "regexp_extract(html, '<h1>([^<]*)</h1>', 1)")
    space = r"'[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g'"
    return {
        "h1_node_table": f"SELECT * FROM ({counts}) WHERE n > 0",
        "h2_select_elements": f"""SELECT page_id, {label} AS label FROM (
            SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS label FROM pages)""",
        "h3_stripped_text": f"SELECT doc_id, trim(regexp_replace(text, {space})) AS text FROM documents",
        "h4_main_content": f"""{f} SELECT path, o_orderkey % 10 <> 0 AS trimmed, o_orderkey % 10 <> 0 AS closed,
            o_orderkey % 10 = 0 AS has_menu FROM facts""",
        "h5_title": f"SELECT page_id, trim(regexp_replace({title}, {space})) AS title FROM pages",
        "h5_recipe_title": f"{w} SELECT path, title FROM recipes",
        "h6_ingredient_groups": f"""WITH {GROUPS} SELECT path, flag_pos AS group_pos,
            CASE l_returnflag WHEN 'N' THEN 'part_' || (flag_pos + 1) ELSE 'For ' || l_returnflag END AS "group",
            in_flag AS pos, line FROM grouped""",
        "h7_instruction_groups": f"""WITH {GROUPS} SELECT path, status_pos AS group_pos,
            CASE l_linestatus WHEN 'F' THEN 'part_1' ELSE 'Finish:' END AS "group",
            in_status AS pos, 'Add the ' || name || '.' AS line FROM grouped""",
        "h8_summary": f"{f} SELECT path, servings, prep_time, cook_time FROM facts",
        "h9_authors": f"{f} SELECT path, author FROM facts",
        "h10_description": f"{f} SELECT path, description FROM facts",
        "h11_ratings": f"{f} SELECT path, rating, make_again, CAST(ratings AS VARCHAR) AS ratings FROM facts",
        "h12_rating_ratio": """SELECT o_orderkey,
            CASE WHEN o_orderkey % 5 > 0 THEN round((o_orderkey % 9)::DOUBLE / (o_orderkey % 5)::DOUBLE, 9) END AS value FROM orders""",
        "h13_percent_ratio": """SELECT o_orderkey,
            CASE WHEN o_orderkey % 2 = 0 THEN round((o_orderkey % 101) * 0.01::DOUBLE, 2) END AS value FROM orders""",
        "h14_images": f"{f} SELECT path, image_url, {location} AS image_location FROM facts",
        "h15_image_plan": f"""SELECT '/o/' || o_orderkey AS path, 'https://{MARKET}/img/' || o_orderkey || '.png' AS image_url,
            'o%2F' || o_orderkey || '.png' AS file_name FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0""",
        "h15_image_plan_by_site": f"""SELECT host AS domain, '/o/' || o_orderkey AS path, 'https://' || host || '/img/' || o_orderkey || '.png' AS image_url,
            'o%2F' || o_orderkey || '.png' AS file_name FROM orders, (VALUES ('{MARKET}', 0), ('{SECOND}', 1)) h(host, half)
            WHERE o_orderstatus = 'F' AND NOT (o_orderkey % 3 = 0 AND o_orderkey % 2 = half)""",
        "h16_recipe_rows": f"""{w} SELECT domain, path, title, CAST(n_parts AS VARCHAR) AS parts, CAST(n_lines AS VARCHAR) AS lines,
            servings, author, rating, {location} AS image_location FROM recipes""",
        "h17_layout_table": f"""{w}, states AS (SELECT l_orderkey, count(DISTINCT l_linestatus) AS n FROM lp GROUP BY 1)
            SELECT path, CASE WHEN c_nationkey % 2 = 1 THEN split_part(author, chr(10), 1) ELSE title END AS title,
              CAST(CASE WHEN c_nationkey % 2 = 1 THEN n ELSE n_parts END AS VARCHAR) AS parts,
              CASE WHEN c_nationkey % 2 = 1 THEN cook_time ELSE servings END AS servings,
              CASE WHEN c_nationkey % 2 = 0 THEN prep_time END AS prep_time
            FROM recipes LEFT JOIN states USING (l_orderkey)""".replace("USING (l_orderkey)", "ON l_orderkey = o_orderkey"),
        "h17_site_layouts": f"""{w} SELECT path,
            CASE WHEN c_nationkey % 2 = 1 THEN author ELSE title END AS title FROM recipes""",
    }


def all_sql() -> dict[str, str]:
    return {**analytics(), **url_and_link(), **crawl(), **html_and_recipes()}
