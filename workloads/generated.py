"""Generated tables, as many rows as the given tables have ids for.

Decimal amounts are compared as doubles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators import generate as G
from tablesync.operators.counts import max_key_param
from workloads.fixtures import RUN_TEXT, RUN_TS
from workloads.registry import query

NOW = f"CAST('{RUN_TEXT}' AS TIMESTAMP)"


def draw(multiplier: int, size: str | int) -> str:
    """The draw in wide integers: 62 bits spread from the id, times the size, over 2^62."""
    word = 2147483647
    high = f"xor((id >> 31) & {word}, id >> 62)"
    upper = f"(((id & {word}) * {multiplier} + {high} * 1566083941) & {word})"
    lower = f"((xor({upper}, {high}) * {multiplier} + (id & {word})) & {word})"
    spread = f"(CAST({upper} AS HUGEINT) * 2147483648 + {lower})"
    return f"CAST({spread} * {size} // 4611686018427387904 AS BIGINT)"


def pick(multiplier: int, words: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{w}'" for w in words)
    return f"([{listed}])[{draw(multiplier, len(words))} + 1]"


def number(multiplier: int, low: int, size: str | int, kind: str = "INTEGER") -> str:
    return f"CAST({draw(multiplier, size)} + {low} AS {kind})"


def cents(multiplier: int, low: int, size: int) -> str:
    return f"CAST(({draw(multiplier, size)} + {low}) / 100 AS DOUBLE)"


def padded(prefix: str, width: int, suffix: str = "") -> str:
    return f"'{prefix}' || format('{{:0{width}d}}', id) || '{suffix}'"


def numbered(text: tuple[str, str], value: str = "id") -> str:
    return f"'{text[0]}' || {value} || '{text[1]}'"


def largest(ids: str) -> str:
    return f"(SELECT max(id) FROM {{{ids}}})"


def amounts(df, *columns: str):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query("gen_users", f"""
SELECT id, {padded('User', 6)} AS name, 'user' || id || '@email.com' AS email,
       '{G.SEED_PASSWORD}' AS password, {number(1103515245, 18, 65)} AS age,
       {pick(1640531527, G.CITIES)} AS city, 'Brasil' AS country,
       {NOW} AS created_at, {NOW} AS updated_at
FROM {{user_ids}}""")
def gen_users(i):
    return G.gen_users(i["user_ids"], RUN_TS)


PRODUCTS_SQL = f"""
SELECT id, {padded('Product ', 6)} AS name,
       {numbered(G.PRODUCT_TEXT)} AS description,
       {cents(1812433253, 1000, 200001)} AS price, {number(134775813, 1, 50)} AS category_id,
       {number(1566083941, 0, 1000)} AS stock, {padded('SKU', 8)} AS sku,
       {cents(747796405, 10, 5001)} AS weight, true AS is_active,
       {NOW} AS created_at, {NOW} AS updated_at
FROM {{product_ids}}"""


@query("gen_products", PRODUCTS_SQL)
def gen_products(i):
    return amounts(G.gen_products(i["product_ids"], RUN_TS), "price", "weight")


@query("gen_orders", f"""
SELECT id, {number(1103515245, 1, largest('user_ids'), 'BIGINT')} AS user_id,
       {cents(1812433253, 5000, 200001)} AS total, {pick(1640531527, G.ORDER_STATUSES)} AS status,
       {numbered(G.ADDRESS_TEXT, number(134775813, 1, 999))} AS shipping_address,
       {NOW} AS order_date, CAST(NULL AS TIMESTAMP) AS shipped_date,
       CAST(NULL AS TIMESTAMP) AS delivered_date, {NOW} AS created_at, {NOW} AS updated_at
FROM {{order_ids}}""")
def gen_orders(i):
    users = max_key_param(i["user_ids"], "id")
    return amounts(G.gen_orders(i["order_ids"], users, RUN_TS), "total")


@query("gen_order_items", f"""
SELECT id, {number(1103515245, 1, largest('order_ids'), 'BIGINT')} AS order_id,
       {number(1640531527, 1, largest('product_ids'), 'BIGINT')} AS product_id,
       {number(134775813, 1, 10)} AS quantity, {cents(1812433253, 1000, 50001)} AS price,
       {NOW} AS created_at
FROM {{item_ids}}""")
def gen_order_items(i):
    orders = max_key_param(i["order_ids"], "id")
    products = max_key_param(i["product_ids"], "id")
    return amounts(G.gen_order_items(i["item_ids"], orders, products, RUN_TS), "price")


@query("gen_authors", f"""
SELECT id, {padded('Author ', 4)} AS name, 'author' || id || '@blog.com' AS email,
       {numbered(G.AUTHOR_TEXT)} AS bio,
       CAST(NULL AS VARCHAR) AS website, CAST(NULL AS VARCHAR) AS social_media,
       {NOW} AS created_at
FROM {{author_ids}}""")
def gen_authors(i):
    return G.gen_authors(i["author_ids"], RUN_TS)


@query("gen_tags", f"""
SELECT id, {padded('Tag ', 3)} AS name, {padded('tag-', 3)} AS slug, {NOW} AS created_at
FROM {{product_ids}}""")
def gen_tags(i):
    return G.gen_tags(i["product_ids"], RUN_TS)


@query("gen_posts", f"""
SELECT id, {padded(G.POST_TITLE[0], 6, G.POST_TITLE[1])} AS title,
       {padded('blog-post-', 6)} AS slug,
       {numbered(G.POST_TEXT)} AS content, {numbered(G.POST_EXCERPT)} AS excerpt,
       {number(1103515245, 1, largest('author_ids'), 'BIGINT')} AS author_id,
       {draw(1640531527, 10)} >= 3 AS published, false AS featured,
       {number(134775813, 0, 10000)} AS views,
       CASE WHEN {draw(1640531527, 10)} >= 3
            THEN {NOW} - to_days(CAST({draw(1566083941, 365)} AS INTEGER)) END AS published_at,
       {NOW} AS created_at, {NOW} AS updated_at
FROM {{user_ids}}""")
def gen_posts(i):
    authors = max_key_param(i["author_ids"], "id")
    return G.gen_posts(i["user_ids"], authors, RUN_TS)


@query("gen_comments", f"""
SELECT id, {number(1103515245, 1, largest('user_ids'), 'BIGINT')} AS post_id,
       {padded('Commenter ', 6)} AS author_name,
       'commenter' || id || '@example.com' AS author_email,
       {numbered(G.COMMENT_TEXT)} AS content,
       {draw(1640531527, 10)} >= 2 AS approved, CAST(NULL AS VARCHAR) AS ip_address,
       CAST(NULL AS VARCHAR) AS user_agent, {NOW} AS created_at
FROM {{order_ids}}""")
def gen_comments(i):
    posts = max_key_param(i["user_ids"], "id")
    return G.gen_comments(i["order_ids"], posts, RUN_TS)


@query("gen_post_tags", f"""
SELECT min(id) AS id, post_id, tag_id, {NOW} AS created_at
FROM (SELECT id, {number(1103515245, 1, largest('user_ids'), 'BIGINT')} AS post_id,
             {number(1640531527, 1, largest('product_ids'), 'BIGINT')} AS tag_id
      FROM {{order_ids}})
GROUP BY post_id, tag_id""")
def gen_post_tags(i):
    posts, tags = (max_key_param(i[ids], "id") for ids in ("user_ids", "product_ids"))
    return G.gen_post_tags(i["order_ids"], posts, tags, RUN_TS)


@query("gen_events", f"""
SELECT id, {number(1103515245, 1, 50000)} AS user_id,
       'session_' || {number(1640531527, 1, 100000)} AS session_id,
       {pick(1812433253, G.EVENT_TYPES)} AS event_type, CAST(NULL AS VARCHAR) AS event_data,
       'https://example.com/' || {pick(134775813, G.EVENT_PAGES)} AS url,
       CAST(NULL AS VARCHAR) AS user_agent, CAST(NULL AS VARCHAR) AS ip_address,
       {pick(1566083941, G.EVENT_COUNTRIES)} AS country, {pick(747796405, G.EVENT_CITIES)} AS city,
       {pick(1013904223, G.DEVICES)} AS device_type, {pick(22695477, G.BROWSERS)} AS browser,
       {pick(1597334677, G.SYSTEMS)} AS os, {NOW} AS created_at
FROM {{event_ids}}""")
def gen_events(i):
    return G.gen_events(i["event_ids"], RUN_TS)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


TREE_SQL = " UNION ALL ".join(
    f"SELECT {n} AS id, {quoted(name)} AS name, "
    f"CAST({'NULL' if parent is None else parent} AS INTEGER) AS parent_id"
    for n, (name, _, parent) in enumerate(G.CATEGORIES, start=1)
)


@query("category_tree", f"""
SELECT r.id AS root_id, r.name AS root_name,
       (SELECT count(*) FROM ({TREE_SQL}) c WHERE c.parent_id = r.id) AS children,
       count(p.id) AS products, CAST(coalesce(sum(p.stock), 0) AS BIGINT) AS stock
FROM ({TREE_SQL}) r
LEFT JOIN ({TREE_SQL}) m ON m.id = r.id OR m.parent_id = r.id
LEFT JOIN ({PRODUCTS_SQL}) p ON p.category_id = m.id
WHERE r.parent_id IS NULL GROUP BY r.id, r.name""")
def category_tree(i):
    products = G.gen_products(i["product_ids"], RUN_TS)
    return G.products_by_root(products, G.category_tree(i.spark, RUN_TS))
