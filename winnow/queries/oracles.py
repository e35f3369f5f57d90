"""SQL statements of the registered queries, written from the rules and not from the plans.

They run in another engine, whose patterns know ASCII word boundaries only, so text is
mapped before terms are counted; windows and lists stand in for Spark's own operators.
"""

from __future__ import annotations

from winnow.functions.text import LANGUAGES, TERMS

SPACES = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
UNSEEN = (
    r"(?is)<script\b.*?(?:</script[^>]*>|\z)|<style\b.*?(?:</style[^>]*>|\z)|<!--.*?(?:-->|\z)"
)
TITLE = r"(?is)<title\b[^>]*>(.*?)</title[^>]*>"
QUOTED = r"""(?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*"""
MARK = rf"<[A-Za-z/!?]{QUOTED}>"
ANCHOR = rf"(?is)<a\s{QUOTED}>.*?(?:</a\s*>|\z)"
BLOCK = (
    r"(?i)</?(?:address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figcaption|figure"
    r"|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th"
    rf"|thead|tr|ul)(?:\s{QUOTED})?/?>|<br\s*/?>\s*<br\s*/?>"
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(value: str, pattern: str, to: str) -> str:
    return f"regexp_replace({value}, {q(pattern)}, {q(to)}, 'g')"


def pick(value: str, pattern: str, group: int) -> str:
    return f"regexp_extract({value}, {q(pattern)}, {group})"


def strip(value: str) -> str:
    return sub(value, rf"^{SPACES}+|{SPACES}+\z", "")


def decode(value: str) -> str:
    known = {"&quot;": '"', "&copy;": "©", "&middot;": "·", "&lt;": "<", "&gt;": ">", "&amp;": "&"}
    for name, char in known.items():
        value = f"replace({value}, {q(name)}, {q(char)})"
    return value


def part(url: str, group: int) -> str:
    return pick(sub(url, r"^[\x00-\x20]+|[\t\r\n]", ""), PARTS, group)


def path(url: str) -> str:
    return sub(part(url, 3), r";[^/]*\z", "")


def canonical(url: str) -> str:
    return f"lower({part(url, 1)}) || '://' || {part(url, 2)} || {part(url, 3)}"


def original(url: str) -> str:
    inner = sub(pick(url, r"(?s)/(http.*)\z", 1), r":\p{Nd}{1,5}/", "/")
    return f"CASE WHEN contains({url}, 'archive.org') THEN {inner} ELSE {url} END"


def full_size(url: str) -> str:
    return sub(url, r"(?i)/s\p{Nd}{1,4}/", "/s0/")


def fix_scheme(url: str) -> str:
    return (
        f"CASE WHEN starts_with({url}, '//') THEN 'http:' || {url}"
        f" WHEN starts_with({url}, '://') THEN 'http' || {url}"
        f" WHEN starts_with({url}, 'hhttp') THEN substr({url}, 2) ELSE {url} END"
    )


def fix_image(url: str) -> str:
    fixed = fix_scheme(url)
    return (
        f"CASE WHEN contains({url}, 'archive.org') THEN {fixed} ELSE {full_size(fixed)} END"
    )


def is_image(url: str) -> str:
    return f"regexp_matches({path(url)}, {q(r'(?i)\.(jpe?g|png|gif|bmp|webp|avif)')})"


def is_wanted(url: str) -> str:
    low = f"lower({url})"
    ignored = [
        "www.amazon", "amzn.to", "amzn.com", "ravelry.com", "greatamigurumi.blogspot", "mailto:",
        "drive.google.com", "youtube.com", "facebook.com",
    ]
    hits = " OR ".join(f"contains({low}, {q(word)})" for word in ignored)
    return f"NOT ({hits} OR {is_image(low)} OR ends_with({low}, '.pdf'))"


def is_candidate(url: str) -> str:
    return f"NOT regexp_matches({url}, '(?i)^(?:javascript|mailto):.+|share')"


def terms(text: str) -> str:
    plain = sub(sub(text, r"[^\P{Nd}0-9]", "0"), r"[\x{80}-\x{10FFFF}]", "z")
    return f"len(regexp_extract_all({plain}, {q('(?im)' + TERMS)}))"


def clean_page(text: str) -> str:
    return sub(strip(text), r"(?:[ ]*\n[ ]*){2,}", "\n\n")


def clean_post(text: str) -> str:
    tight = sub(sub(strip(text), " {2,}", " "), " ?\n ?", "\n")
    return f"replace({tight}, {q(chr(10))}, {q(chr(92) + 'n')})"


def nodes(html: str) -> str:
    spaced = sub(html, r"(?i)&(?:nbsp|#160|#xa0);", "\u00a0")
    parts = f"list_transform(string_split_regex({spaced}, {q(MARK)}), lambda t: {strip('t')})"
    return decode(f"array_to_string(list_filter({parts}, lambda t: t <> ''), ' ')")


def visible(html: str) -> str:
    return sub(html, UNSEEN, "")


def title(html: str) -> str:
    return strip(decode(pick(html, TITLE, 1)))


def body(html: str) -> str:
    untitled = sub(visible(html), TITLE, "")
    return sub(untitled, r"(?is)^.*?<body\b[^>]*>", "")


def fast_text(html: str) -> str:
    head = (
        f"CASE WHEN regexp_matches({visible(html)}, {q(TITLE)})"
        f" THEN '<title>' || {title(visible(html))} || '</title>' ELSE '' END"
    )
    return f"({head}) || {nodes(body(html))}"


def export_name(count: str, length: str, name: str, extension: str) -> str:
    plain = f"trim({sub(name, '[^a-zA-Z0-9 ]', '')})"
    words = f"array_to_string(string_split_regex({plain}, ' +')[1:4], '_')"
    return f"({count})::VARCHAR || '_' || ({length})::VARCHAR || '_' || {words} || '.{extension}'"


def languages(text: str, tags: str) -> str:
    names = "[" + ", ".join(q(name) for name in LANGUAGES) + "]"
    found = f"regexp_extract_all({text}, {q('(?i)(' + '|'.join(LANGUAGES) + ')')})"
    known = f"list_filter({tags}, lambda t: list_contains({names}, t))"
    cased = f"list_transform({found} || {known}, lambda t: upper(t[1]) || lower(t[2:]))"
    return (
        f"list_transform(list_filter([{{'l': {cased}}}], lambda r: true), lambda r:"
        " list_filter(r.l, lambda t, i: list_position(r.l, t) = i))[1]"
    )


FORMS = rf"""forms AS (
  SELECT page_id, (generate_subscripts(f, 1) - 1)::INT AS form, unnest(f) AS url
  FROM (SELECT page_id, [
    url,
    'https://web.archive.org/web/20190704101112/'
      || regexp_replace(url, '(example\.[a-z]+)/', '\1:8080/', 'g'),
    'https://archive.org/details' || {part('url', 3)},
    regexp_replace(url, '^[a-z]+:', ''),
    regexp_replace(url, '^[a-z]+', ''),
    'h' || url,
    regexp_replace(url, '[?#].*', '') || '/S320/s64/my+pic%20one%zz.JPG;v=1?x=.pdf',
    regexp_replace(url, '[?#].*', '') || '/a b;p=1/c.html;q=2',
    'mailto:someone@' || {part('url', 2)},
    url || '/Share.pdf',
    NULL] AS f FROM pages))"""

CAPTURES = """captures AS (
  SELECT page_id * 4 AS ord, url AS target_uri,
    CASE WHEN contains(url, '#') THEN '404 Not Found' ELSE '200 OK' END AS statusline,
    html AS content FROM pages
  UNION ALL
  SELECT page_id * 4 + 1, 'https://web.archive.org/web/20200101000000/' || url, '200 OK', html
  FROM pages
  UNION ALL
  SELECT page_id * 4 + 2, 'https://web.archive.org/web/20210101000000/' || url, '200 OK',
    replace(html, '</article>', '<p>row 1</p></article>') FROM pages
  UNION ALL
  SELECT page_id * 4 + 3, url || '-copy',
    CASE WHEN contains(html, '</body>') THEN '200 OK' ELSE 'broken' END, html FROM pages),
typed AS (
  SELECT *, TRY_CAST(regexp_extract(statusline, '^\\s*(\\S+)', 1) AS INT) AS status,
    length(content) AS content_length FROM captures)"""

POST_BASE = """mentions AS (
  SELECT page_id // 3 AS conv_id, list(url ORDER BY page_id) AS urls FROM pages GROUP BY 1),
base AS (
  SELECT c.conv_id, c.turn, c.role, c.text, coalesce(m.urls, []) AS urls,
    c.conv_id * 1024 + c.turn // 64 AS page_idx, c.turn % 64 AS post_idx,
    row_number() OVER (ORDER BY c.conv_id, c.turn) - 1 AS post_no,
    c.conv_id || '-' || c.turn AS place,
    DATE '2020-01-01' + (c.conv_id % 5000)::INT AS day
  FROM conversations c LEFT JOIN mentions m USING (conv_id))"""

_RAW_TEXT = "'  ' || text || ' ' || chr(10) || ' written in FRENCH,  polishing by ' || role || ' '"
_TAGS = "[role, CASE WHEN role = 'user' THEN 'Korean' ELSE 'korean' END]"

POSTS = f"""{POST_BASE},
posts AS (
  SELECT *, printf('%05d', post_no) AS ptid, strftime(day, '%b %-d, %Y') AS post_date,
    {pick('text', '^[^.' + chr(10) + ']*', 0)} AS post_title,
    'https://blog.example.com/2021/05/' || place || '.html' AS post_link,
    printf('%05d', post_no) || '_2021-05-' || place AS ptid_slug,
    {clean_post(_RAW_TEXT)} AS raw_text, {_TAGS} AS tag_list,
    {languages(_RAW_TEXT, _TAGS)} AS languages,
    flatten(list_transform(urls, lambda u: [u, u || '-copy'])) AS text_links,
    urls || list_transform(urls, lambda u: 'https://web.archive.org/web/20200101000000/' || u)
      || ['http://www.amazon.com/' || place, 'http://files.example.com/' || place || '.PDF',
          'http://img.example.com/s1600/' || place || '.gif'] AS raw_links,
    ['http://img.example.com/s0/' || role || '.png',
     'https://img.example.com/' || place || '.webp'] AS raw_images
  FROM base)"""

LINKS = f"""{POSTS},
placed_links AS (
  SELECT post_no, day::VARCHAR AS post_date, generate_subscripts(raw_links, 1) - 1 AS pos,
    unnest(raw_links) AS url FROM posts),
links AS (SELECT * FROM placed_links WHERE {is_wanted('url')})"""

EXTRACTS = f"""{CAPTURES},
raw_text AS (
  SELECT ord, target_uri AS url, status, content_length, content,
    {clean_page(fast_text('content'))} AS text
  FROM typed WHERE status <= 399),
extracts AS (
  SELECT *, {terms('text')} AS term_count, {pick('text', '<title>(.+)</title>', 1)} AS title,
    {original('url')} AS origurl FROM raw_text)"""

CORPUS = f"""{EXTRACTS}, {POSTS},
mentioned AS (SELECT post_no, unnest(text_links) AS text_link FROM posts),
joined AS (
  SELECT e.*, m.post_no FROM extracts e JOIN mentioned m ON e.origurl = m.text_link),
one_text AS (
  SELECT * FROM joined
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY ord, post_no) = 1),
best AS (
  SELECT * FROM one_text QUALIFY row_number() OVER (
    PARTITION BY origurl ORDER BY term_count DESC, content_length DESC, ord) = 1),
corpus AS (
  SELECT b.*, p.ptid, p.post_title, p.ptid_slug, p.raw_text, p.languages, p.tag_list
  FROM best b JOIN posts p USING (post_no))"""


def anchors(name: str, pages_sql: str, href: str = r"""[\s"']href\s*=\s*["']([^"']*)["']""") -> str:
    """CTE of anchors with absolute link; the links of the tables are host paths or whole URLs."""
    value = decode(pick("el", "(?is)" + href, 1))
    inner = sub("el", rf"(?is)^<a\s{QUOTED}>|</a\s*>\z", "")
    texts = f"list_filter(string_split_regex({inner}, {q(MARK)}), lambda t: t <> '')"
    return f"""{name}_all AS (
  SELECT ord, url, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS el FROM (
    SELECT ord, url, regexp_extract_all({visible('html')}, {q(ANCHOR)}) AS a
    FROM ({pages_sql}))),
{name} AS (
  SELECT ord, url, pos,
    CASE WHEN regexp_matches({value}, '^[a-z]+:') THEN {value}
      ELSE {pick('url', '^([a-z]+://[^/?#]*)', 1)} || {value} END AS link,
    {strip(decode(f"array_to_string({texts}, ' ')"))} AS spaced,
    {strip(decode(f"array_to_string({texts}, '')"))} AS link_text
  FROM {name}_all)"""


def first_links(source: str) -> str:
    """Rows ``ord, pos, link, link_text`` of the first candidate anchor per link."""
    return f"""firsts AS (
  SELECT * FROM {source} WHERE {is_candidate('link')}
  QUALIFY row_number() OVER (PARTITION BY ord, link ORDER BY pos) = 1),
first_links AS (
  SELECT ord, row_number() OVER (PARTITION BY ord ORDER BY pos) - 1 AS pos, link, link_text
  FROM firsts)"""


_ODD = (
    "<article><p title=''x > y''>shown</p>a < b and c > d "
    "<a title=''m > n'' href=''/quoted''><b>one</b><i>two</i></a>"
)
PAGE_ROWS = (
    f"SELECT page_id AS ord, url, replace(html, '<article>', '{_ODD}') || '<p>late &amp; last</p>' AS html"
    " FROM pages"
)
# What a reader of the odd anchors finds: path, text nodes joined by blanks, and joined directly.
ODD_LINKS = """odd AS (SELECT * FROM (VALUES
  (0, '/good', 'titled', 'titled'), (1, '/open', 'open  par  and', 'open par and'), (2, '/next/', 'next', 'next'),
  (3, '/outer', 'one', 'one'), (4, '/alt', 'see   it', 'see  it'), (5, '/upper', 'up', 'up'),
  (6, '/last', 'rest  of it', 'rest of it')) AS v(k, path, spaced, link_text))"""
ODD_FOUND = f"""{ODD_LINKS}, {anchors('own', "SELECT page_id AS ord, url, html FROM pages")},
found AS (
  SELECT ord, pos, link, spaced, link_text FROM own
  UNION ALL
  SELECT page_id, 100000 + k, {pick('url', '^([a-z]+://[^/?#]*)', 1)} || path, spaced, link_text
  FROM pages, odd)"""
PICTURES = (
    "SELECT page_id AS ord, url, regexp_replace(html, '<a href=\"/([^\"]*)\">([^<]*)</a>',"
    " '<img width=320 src=''/s320/\\1.jpg'' alt=\"\\2\" />', 'g') AS html FROM pages"
)
PICTURE_LIST = f"""pictures AS (
  SELECT ord, url, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS el FROM (
    SELECT ord, url, regexp_extract_all({visible('html')}, '(?is)<img\\s[^>]*>') AS a
    FROM ({PICTURES}))),
picture_parts AS (
  SELECT ord, url, pos, {decode(pick('el', r"src='([^']*)'", 1))} AS path,
    {decode(pick('el', 'alt="([^"]*)"', 1))} AS alt, {pick('url', '^([a-z]+://[^/?#]*)', 1)} AS host
  FROM pictures)"""

PICTURE_ROWS = f"""picture_rows AS (
  SELECT page_id AS ord, printf('%05d', page_id // 10) AS ptid,
    'my_' || {pick('html', 'lang="([a-z]*)"', 1)} || '_pic.jpg' AS fname,
    CASE WHEN NOT contains(url, '#') THEN html END AS content FROM pages)"""


def simplified(html: str, source: str) -> str:
    """CTE ``simple(ord, text)`` of title and content blocks; ``source`` yields ord, html."""

    def words(text: str) -> str:
        return f"len(regexp_extract_all({sub(text, MARK, ' ')}, '[^\\s]+'))"

    linked = f"array_to_string(regexp_extract_all(markup, {q(ANCHOR)}), ' ')"
    return f"""pieces AS (
  SELECT ord, generate_subscripts(b, 1) AS place, unnest(b) AS markup FROM (
    SELECT ord, string_split_regex({body(html)}, {q(BLOCK)}) AS b FROM ({source}))),
counted AS (
  SELECT ord, place, {strip('markup')} AS markup, {words('markup')} AS n,
    {words(linked)} AS linked FROM pieces),
filled AS (SELECT * FROM counted WHERE n > 0),
around AS (
  SELECT *, lag(n) OVER w AS pn, lag(linked) OVER w AS pl, lead(n) OVER w AS nn
  FROM filled WINDOW w AS (PARTITION BY ord ORDER BY place)),
content AS (
  SELECT ord, string_agg('<p>' || markup || '</p>', '' ORDER BY place) AS blocks FROM around
  WHERE linked * 3 <= n AND CASE WHEN pn IS NULL OR pl * 9 <= pn * 5
    THEN n > 16 OR coalesce(nn, 0) > 15 OR coalesce(pn, 0) > 4
    ELSE n > 40 OR coalesce(nn, 0) > 17 END
  GROUP BY ord),
simple AS (
  SELECT s.ord, '<h1><strong>' || {title(f's.{html}')} || '</strong></h1>'
    || coalesce(c.blocks, '') AS text
  FROM ({source}) s LEFT JOIN content c USING (ord))"""


def _forms(expression: str) -> str:
    return f"WITH {FORMS} SELECT page_id, form, {expression} AS result FROM forms"


def _joined(column: str) -> str:
    return f"array_to_string({column}, '|') AS {column}"


def front_matter() -> str:
    texts = ["title", "post_title", "raw_text", "languages", "tag_list"]
    lines = [f"'{name}: ' || to_json({name})::VARCHAR" for name in texts]
    lines += [f"'{name}: ' || {name}::VARCHAR" for name in ("term_count", "content_length")]
    lines.append("'url: ' || to_json(url)::VARCHAR")
    return "'---' || chr(10) || " + " || chr(10) || ".join(lines) + " || chr(10) || '---' || chr(10) || chr(10)"


def last_per_path(path_sql: str, body_sql: str) -> str:
    return f"""WITH {CORPUS}, files AS (
  SELECT origurl, {path_sql} AS path, {body_sql} AS body FROM corpus)
SELECT path, body FROM files QUALIFY row_number() OVER (PARTITION BY path ORDER BY origurl DESC) = 1"""


_LABEL_SIMPLE = simplified("html", "SELECT ord, content AS html FROM corpus")
_EXPORT = ("term_count", "content_length", "post_title")
_STAMPS = """event_stamps AS (
  SELECT event_id, event_type, 'https://users.example.com/' || user_id AS url,
    strftime(ts, '%Y%m%d%H%M%S') AS stamp, date_trunc('second', ts) AS at FROM events)"""
_SHA_CONTENT = "sha256(content) AS sha"
_LISTED = """listed AS (
  SELECT ord, string_agg(link, '|' ORDER BY pos) AS links,
    string_agg(link_text, '|' ORDER BY pos) AS link_texts FROM first_links GROUP BY ord)"""
_CORPUS_LINKS = (
    f"{anchors('found', 'SELECT ord, url, content AS html FROM corpus')}, {first_links('found')}, {_LISTED}"
)
_PAGE_COLUMNS = """0 AS n_images, coalesce(links, '') AS links, coalesce(link_texts, '') AS link_texts,
  sha256(content) AS content_sha"""
_FRONT_TYPES = "SELECT page_id, form, url FROM forms"

ORACLES = {
    "original_url": _forms(original("url")),
    "image_full_size": _forms(full_size("url")),
    "fix_scheme": _forms(fix_scheme("url")),
    "fix_image_url": _forms(fix_image("url")),
    "url_file_name": _forms(
        f"replace(url_decode(replace({pick(path('url'), '([^/]*)' + chr(92) + 'z', 1)}, '+', ' ')),"
        " ' ', '_')"
    ),
    "url_slug": _forms(
        f"replace(replace({sub(path('url'), '^/+|/+' + chr(92) + 'z', '')}, '/', '-'), '.html', '')"
    ),
    "canonical_url": _forms(canonical("url")),
    "image_url_filter": f"WITH {FORMS} {_FRONT_TYPES} WHERE {is_image('url')}",
    "link_filter": f"WITH {FORMS} {_FRONT_TYPES} WHERE {is_wanted('url')}",
    "link_candidates": f"""WITH {FORMS}, tagged AS (
  SELECT *, CASE form WHEN 5 THEN 'link' WHEN 6 THEN 'img' ELSE 'a' END AS tag FROM forms)
SELECT page_id, form, tag, url FROM tagged
WHERE tag IN ('a', 'img') AND {is_candidate('url')}""",
    "split_archived": f"""WITH {FORMS} SELECT page_id, form,
  CASE WHEN contains(url, 'web.archive.org') THEN 'archived' ELSE 'live' END AS side
FROM forms WHERE url IS NOT NULL""",
    "image_fallback": f"""WITH {FORMS} SELECT page_id, form,
  {pick('url', '(?s)/(http.*)' + chr(92) + 'z', 1)} AS retry_url
FROM forms WHERE NOT contains(url, '#') AND contains(url, 'archive.org')""",
    "image_path": f"""WITH {PICTURE_ROWS}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY ptid, fname ORDER BY ord) - 1 AS same
  FROM picture_rows)
SELECT ord, ptid, '/images/' || ptid || '/' || CASE WHEN same > 0 THEN same || '_' ELSE '' END
  || fname AS path FROM numbered""",
    "image_path_clash": """WITH names AS (
  SELECT page_id AS ord, printf('%05d', page_id // 10) AS ptid,
    CASE page_id % 5 WHEN 2 THEN 'mypic.jpg' WHEN 3 THEN '1_pic.jpg' ELSE 'pic.jpg' END AS fname
  FROM pages),
counted AS (
  SELECT a.ord, a.ptid, a.fname,
    count(*) FILTER (b.ord < a.ord) AS number,
    count(*) FILTER (b.ord < a.ord AND b.fname = a.fname) AS same,
    max(CASE WHEN regexp_matches(b.fname, '^[0-9]+_') AND substr(b.fname, strpos(b.fname, '_') + 1) = a.fname
      THEN strpos(b.fname, '_') - 1 ELSE 0 END) AS wide
  FROM names a JOIN names b ON a.ptid = b.ptid AND suffix(b.fname, a.fname) GROUP BY ALL),
sized AS (
  SELECT *, greatest(wide, length(max(number) OVER (PARTITION BY ptid, fname)::VARCHAR)) + 1 AS width,
    EXISTS (SELECT 1 FROM names n WHERE n.ptid = c.ptid AND n.fname = c.number || '_' || c.fname) AS clash
  FROM counted c)
SELECT ord, ptid, '/images/' || ptid || '/' || CASE WHEN same = 0 THEN ''
  WHEN clash THEN lpad(number::VARCHAR, width::INT, '0') || '_' ELSE number || '_' END || fname AS path
FROM sized""",
    "snapshot_stamp": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || '000000' AS stamp FROM orders",
    "parse_post_date": """SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE::VARCHAR END AS day FROM orders""",
    "clean_post_text": "SELECT doc_id, "
    + clean_post(
        "chr(9) || '  ' || replace(text, ', ', ',   ' || chr(10) || '  ') || ' ' || chr(10)"
    )
    + " AS text FROM documents",
    "clean_page_text": "SELECT doc_id, "
    + clean_page(
        "' ' || chr(10) || replace(text, chr(10), '  ' || chr(10) || ' ' || chr(10))"
    )
    + " AS text FROM documents",
    "term_count": f"SELECT doc_id, {terms('text')} AS term_count FROM documents",
    "min_terms": f"""SELECT doc_id, {terms('text')} AS term_count FROM documents
WHERE {terms('text')} >= 2""",
    "detect_languages": "SELECT doc_id, array_to_string("
    + languages(
        "text || ' Englishman. In ' || source || 'FRENCH, french'",
        "[source, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French'"
        " WHEN 'de' THEN 'German' ELSE 'spanish' END, 'Thai']",
    )
    + ", '|') AS languages FROM documents",
    "page_title": f"SELECT ord, {title('html')} AS title FROM ({PAGE_ROWS})",
    "export_name": f"SELECT doc_id, {export_name(terms('text'), 'n_chars', 'text', 'md')} AS name"
    " FROM documents",
    "flatten_posts": f"""WITH {POSTS} SELECT page_idx, post_idx, post_date, post_title, post_link,
  {_RAW_TEXT.replace('text', 'b.text').replace('role', 'b.role')} AS raw_text,
  array_to_string(flatten(list_transform(p.urls, lambda u: ['h' || u, u || '-copy'])), '|') AS links,
  array_to_string(tag_list, '|') AS tag_list
FROM posts p JOIN (SELECT post_no, text, role FROM base) b USING (post_no)""",
    "posts_per_page": f"""WITH {POST_BASE} SELECT page_idx,
  'https://blog.example.com/search?start=' || page_idx AS url, count(*) AS num_posts
FROM base GROUP BY page_idx""",
    "post_ids": f"""WITH {POST_BASE}
SELECT page_idx, post_idx, printf('%05d', post_no) AS ptid FROM base""",
    "fix_post_links": f"""WITH {POSTS} SELECT page_idx, post_idx, {_joined('raw_images')},
  {_joined('raw_links')},
  CASE WHEN len(urls) > 0 THEN 'http://img.example.com/s0/' || place || '.jpg' END AS img_link,
  CASE WHEN len(urls) > 0 THEN 'https://img.example.com/s0/' || place || '.png' END AS img_src,
  urls[1] AS text_link FROM posts""",
    "posts": f"""WITH {POSTS} SELECT ptid, post_date, post_title, post_link, raw_text, ptid_slug,
  {_joined('tag_list')}, {_joined('languages')}, {_joined('text_links')}, {_joined('raw_links')},
  {_joined('raw_images')} FROM posts""",
    "post_images": f"""WITH {POSTS}, shown AS (
  SELECT post_no, unnest(raw_images) AS imgurl FROM posts
  UNION ALL
  SELECT post_no, unnest(['https://img.example.com/s0/' || place || '.png',
    'http://img.example.com/s0/' || place || '.jpg']) FROM posts WHERE len(urls) > 0
  UNION ALL
  SELECT post_no, {fix_image('link')} FROM (
    SELECT post_no, unnest(raw_links) AS link FROM posts) WHERE {is_image('link')})
SELECT imgurl, printf('%05d', min(post_no)) AS ptid FROM shown GROUP BY imgurl""",
    "dated_links": f"WITH {LINKS} SELECT DISTINCT post_date, url FROM links",
    "page_text": f"SELECT ord, {fast_text('html')} AS text FROM ({PAGE_ROWS})",
    "page_text_plain": f"SELECT ord, {nodes(visible('html'))} AS text FROM ({PAGE_ROWS})",
    "absolute_links": f"""WITH hrefs AS (
  SELECT ord, url, generate_subscripts(h, 1) - 1 AS pos, unnest(h) AS href FROM (
    SELECT page_id AS ord, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages)),
split AS (
  SELECT *, substr(href, 2) AS name, {part('url', 1)} AS scheme,
    {part('url', 1)} || '://' || {part('url', 2)} AS root, {part('url', 3)} AS base_path,
    {pick('url', '(' + chr(92) + '?[^#]*)', 1)} AS base_query FROM hrefs),
folders AS (
  SELECT *, regexp_replace(base_path, '[^/]*$', '') AS folder,
    regexp_replace(regexp_replace(base_path, '[^/]*$', ''), '[^/]+/$', '') AS above FROM split),
resolved AS (
  SELECT ord, pos, [
    root || href,
    scheme || '://cdn.example.com' || href,
    root || base_path || '?q=1',
    root || base_path || base_query || '#top',
    CASE WHEN name = '' THEN url WHEN regexp_matches(name, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN name
      ELSE root || folder || name END,
    root || above || name,
    root || folder || name,
    'mailto:' || name,
    url] AS links FROM folders)
SELECT ord, pos, generate_subscripts(links, 1) - 1 AS form, unnest(links) AS link FROM resolved""",
    "page_images": f"""WITH {PICTURE_LIST}
SELECT ord, pos, host || path AS src, alt, '320' AS width FROM picture_parts""",
    "page_links": f"WITH {anchors('found', PAGE_ROWS)}, {first_links('found')}"
    " SELECT ord, pos, link, link_text FROM first_links",
    "odd_anchor_links": f"WITH {ODD_FOUND}, {first_links('found')}"
    " SELECT ord, pos, link, link_text FROM first_links",
    "odd_anchor_extracts": f"""WITH {ODD_FOUND}, {first_links('found')}
SELECT ord, string_agg(link, '|' ORDER BY pos) AS links, string_agg(link_text, '|' ORDER BY pos) AS link_texts
FROM first_links GROUP BY ord""",
    "odd_anchor_texts": f"""WITH {ODD_FOUND}, texts AS (
  SELECT ord, link, spaced, min(pos) AS pos FROM found WHERE starts_with(link, 'http')
  GROUP BY ord, link, spaced),
grouped AS (
  SELECT ord, link, min(pos) AS pos,
    coalesce(string_agg(spaced, '|' ORDER BY pos) FILTER (spaced <> ''), '') AS "desc"
  FROM texts GROUP BY ord, link)
SELECT ord, row_number() OVER (PARTITION BY ord ORDER BY pos) - 1 AS pos, link, "desc" FROM grouped""",
    "odd_anchor_classes": f"""WITH {ODD_FOUND}, linked AS (
  SELECT ord, false AS image, link FROM found
  UNION ALL
  SELECT page_id, true, {pick('url', '^([a-z]+://[^/?#]*)', 1)} || '/p.jpg' FROM pages)
SELECT ord, image, contains(link, {part('p.url', 2)}) AS internal, link
FROM linked JOIN pages p ON p.page_id = ord WHERE {is_candidate('link')}""",
    "link_descriptions": "WITH "
    + anchors(
        "found",
        "SELECT ord, url, replace(html, '<article>', '<a href=''/to''>once <b>more</b></a>') AS html"
        f" FROM ({PAGE_ROWS})",
    )
    + """, texts AS (
  SELECT ord, link, spaced, min(pos) AS pos FROM found WHERE starts_with(link, 'http')
  GROUP BY ord, link, spaced),
grouped AS (
  SELECT ord, link, min(pos) AS pos,
    coalesce(string_agg(spaced, '|' ORDER BY pos) FILTER (spaced <> ''), '') AS "desc"
  FROM texts GROUP BY ord, link)
SELECT ord, row_number() OVER (PARTITION BY ord ORDER BY pos) - 1 AS pos, link, "desc" FROM grouped""",
    "classify_links": f"""WITH {PICTURE_LIST}, numbers AS (
  SELECT page_id AS ord, url, {part('url', 2)} AS host,
    len(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>')) AS n FROM pages),
rows AS (
  SELECT p.ord, p.pos, true AS image, p.host || p.path AS link, n.host
  FROM picture_parts p JOIN numbers n USING (ord)
  UNION ALL SELECT ord, n, false, 'https://other.example.com/a', host FROM numbers
  UNION ALL SELECT ord, n + 2, false, 'ftp://files', host FROM numbers)
SELECT ord, pos, image, contains(link, host) AS internal, starts_with(link, 'http') AS schemeok, link
FROM rows WHERE {is_candidate('link')}""",
    "text_images": f"""WITH {PICTURE_LIST}, shown AS (
  SELECT ord, 'http://img.example.com' || replace(path, '/s320/', '/s0/') AS imgurl
  FROM picture_parts)
SELECT imgurl, printf('%05d', min(ord) // 3) AS ptid FROM shown GROUP BY imgurl""",
    "main_content": f"WITH {simplified('html', PAGE_ROWS)} SELECT ord, text FROM simple",
    "captures": f"""WITH {CAPTURES}
SELECT ord, target_uri, status, content_length, {_SHA_CONTENT} FROM typed""",
    "status_filter": f"WITH {CAPTURES} SELECT ord, target_uri, status FROM typed WHERE status <= 399",
    "warc_scan": f"""WITH {CAPTURES} SELECT target_uri, status,
  strlen('HTTP/1.1 ' || statusline || 'xxContent-Type: text/htmlxxxx' || content) AS content_length,
  {_SHA_CONTENT} FROM typed""",
    "warc_split_scan": f"""WITH {CAPTURES} SELECT packed, target_uri, status,
  strlen('HTTP/1.1 ' || statusline || 'xxContent-Type: text/htmlxxxx' || content) AS content_length,
  {_SHA_CONTENT} FROM typed, (SELECT unnest([true, false]) AS packed)""",
    "warc_cdx_scan": f"""WITH {CAPTURES} SELECT target_uri, status,
  strlen('HTTP/1.1 ' || statusline || 'xxContent-Type: text/htmlxxxx' || content) AS content_length,
  {_SHA_CONTENT} FROM typed""",
    "warc_index": f"""WITH {CAPTURES}, blocks AS (
  SELECT target_uri, 'request' AS kind, 18 AS n FROM typed
  UNION ALL
  SELECT target_uri, 'response',
    strlen('HTTP/1.1 ' || statusline || 'xxContent-Type: text/htmlxxxx' || content) FROM typed)
SELECT target_uri, strlen('WARC/1.0xxWARC-Type: ' || kind || 'xxWARC-Target-URI: ' || target_uri
  || 'xxContent-Length: ' || n || 'xxxx') + n + 4 AS length FROM blocks""",
    "warc_quarantine": f"""WITH {CAPTURES}
SELECT CASE WHEN ord % 7 <> 3 THEN target_uri END AS target_uri,
  CASE WHEN ord % 7 <> 3 THEN sha256(content) END AS sha, ord % 7 = 3 AS broken FROM typed""",
    "body_states": """WITH kinds AS (
  SELECT * FROM (VALUES ('whole chunks', NULL), ('cut chunks', 'cut chunks'), ('whole gzip', NULL),
    ('cut gzip', 'cut gzip'), ('not gzip', 'not gzip'), ('br', 'unknown encoding: br')) AS k(kind, state))
SELECT page_id AS ord, kind, state,
  kind IN ('whole chunks', 'cut chunks', 'whole gzip', 'br') AS whole FROM pages, kinds""",
    "warc_metadata": f"""WITH {CAPTURES}
SELECT target_uri, 'request' AS warc_type, '/ HTTP/1.1' AS statusline, '18' AS content_length,
  NULL::VARCHAR AS payload_digest FROM typed
UNION ALL
SELECT target_uri, 'response', statusline,
  strlen('HTTP/1.1 ' || statusline || 'xxContent-Type: text/htmlxxxx' || content)::VARCHAR,
  NULL FROM typed""",
    "warc_headers": f"""WITH {CAPTURES} SELECT 'response' AS warc_type,
  target_uri AS warc_target_uri, 'text/html' AS content_type FROM typed""",
    "merge_scanned": f"""WITH {CAPTURES} SELECT target_uri, status, {_SHA_CONTENT} FROM typed""",
    "merge_captures": f"""WITH {CAPTURES}
SELECT target_uri, sha256(CASE WHEN ends_with(target_uri, '-copy')
  THEN content || '<!-- later -->' ELSE content END) AS sha FROM captures""",
    "stack_headers": """WITH entries AS (
  SELECT ord, generate_subscripts(h, 1) AS pos, unnest(h) AS value FROM (
    SELECT page_id AS ord, regexp_extract_all(html, '<a href="/([^"]*)"', 1) AS h FROM pages))
SELECT ord, lower(substr(value, 1, 1)) AS name, string_agg(value, '|' ORDER BY pos) AS "values"
FROM entries GROUP BY ord, lower(substr(value, 1, 1))""",
    "fetch_tally": f"""WITH {CAPTURES} SELECT count(*) FILTER (status < 400) AS ok_count,
  count(*) FILTER (status IS NULL OR status >= 400) AS fail_count FROM typed""",
    "fetch_results_dated": f"""WITH {CAPTURES}, {LINKS}
SELECT l.url, l.post_no, l.pos, l.post_date, t.status, t.content_length, sha256(t.content) AS sha
FROM links l LEFT JOIN typed t ON t.target_uri = l.url""",
    "image_files": f"""WITH {PICTURE_ROWS}
SELECT ptid, ptid || '/' || fname AS path, {_SHA_CONTENT} FROM picture_rows
WHERE content IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY ptid, fname ORDER BY ord DESC) = 1""",
    "pending_images": f"""WITH {PICTURE_ROWS} SELECT ord, ptid, fname FROM picture_rows p
WHERE NOT EXISTS (SELECT 1 FROM picture_rows r
  WHERE r.content IS NULL AND r.ptid = p.ptid AND r.fname = p.fname)""",
    "nearest_snapshot": f"""WITH {_STAMPS}, ranked AS (
  SELECT r.event_id, r.stamp, r.url, s.stamp AS hit, row_number() OVER (
    PARTITION BY r.event_id ORDER BY abs(epoch(s.at) - epoch(r.at)), s.stamp) AS rank
  FROM event_stamps r LEFT JOIN event_stamps s ON s.url = r.url AND s.event_type = 'purchase'
  WHERE r.event_type = 'click')
SELECT event_id, stamp, hit AS "timestamp",
  'https://web.archive.org/web/' || hit || '/' || url AS archive_url, url AS original
FROM ranked WHERE rank = 1""",
    "snapshot_hits": f"""WITH {_STAMPS}, ranked AS (
  SELECT r.event_id, r.stamp, r.url, s.stamp AS hit, row_number() OVER (
    PARTITION BY r.event_id ORDER BY abs(epoch(s.at) - epoch(r.at)), s.stamp) AS rank
  FROM event_stamps r LEFT JOIN event_stamps s ON s.url = r.url AND s.event_type = 'purchase'
  WHERE r.event_type = 'click'),
hits AS (
  SELECT *, 'https://web.archive.org/web/' || hit || '/' || url AS archive_url
  FROM ranked WHERE rank = 1)
SELECT event_id, stamp, hit IS NOT NULL AS available,
  CASE WHEN hit IS NOT NULL THEN '200' END AS status,
  CASE WHEN hit IS NOT NULL THEN 'com,example,users)/' || regexp_extract(url, '[^/]*$') END AS urlkey,
  hit AS "timestamp", url AS original, CASE WHEN hit IS NOT NULL THEN 'text/html' END AS mimetype,
  CASE WHEN hit IS NOT NULL THEN '200' END AS statuscode, md5(archive_url) AS digest,
  length(archive_url)::VARCHAR AS length, archive_url
FROM hits""",
    "fetch_frontier": f"""WITH {LINKS}, stamped AS (
  SELECT DISTINCT post_date::DATE AS day, {canonical('url')} AS url FROM links),
snapshots AS (
  SELECT {canonical('url')} AS original, unnest([TIMESTAMP '2020-03-01 00:00:00',
    DATE '2020-01-01' + (page_id % 5000)::INT + INTERVAL 12 HOUR]) AS taken FROM pages),
ranked AS (
  SELECT s.day, s.url, h.taken, row_number() OVER (PARTITION BY s.day, s.url
    ORDER BY abs(epoch(h.taken) - epoch(s.day::TIMESTAMP)), h.taken) AS rank
  FROM stamped s JOIN snapshots h ON h.original = s.url
  WHERE NOT contains(s.url, 'web.archive.org'))
SELECT DISTINCT 'live' AS list, url FROM stamped WHERE NOT contains(url, 'web.archive.org')
UNION ALL
SELECT 'archive', url FROM (
  SELECT 'https://web.archive.org/web/' || strftime(taken, '%Y%m%d%H%M%S') || '/' || url AS url
  FROM ranked WHERE rank = 1
  UNION SELECT url FROM stamped WHERE contains(url, 'web.archive.org'))""",
    "ordered_distinct": r"""WITH words AS (
  SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS word FROM (
    SELECT doc_id, string_split_regex(text, '[\s\x0b]+') AS w FROM documents))
SELECT word, min(doc_id * 16777216 + pos) AS ord FROM words GROUP BY word""",
    "dedup_text": """SELECT doc_id, source, n_chars, sha256(text) AS sha FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""",
    "text_extracts": f"""WITH {EXTRACTS},
{anchors('found', 'SELECT ord, url, content AS html FROM extracts')}, {first_links('found')},
listed AS (
  SELECT ord, string_agg(link, '|' ORDER BY pos) AS links,
    string_agg(link_text, '|' ORDER BY pos) AS link_texts FROM first_links GROUP BY ord)
SELECT ord, status, url, origurl, title, content_length, term_count, text, 0 AS n_images,
  coalesce(links, '') AS links, coalesce(link_texts, '') AS link_texts
FROM extracts LEFT JOIN listed USING (ord)""",
    "pages_posts_join": f"""WITH {CORPUS} SELECT j.ord, p.ptid, j.origurl AS text_links,
  p.post_title, sha256(j.text) AS sha FROM joined j JOIN posts p USING (post_no)""",
    "best_per_url": f"""WITH {EXTRACTS} SELECT origurl, ord, term_count, content_length FROM extracts
QUALIFY row_number() OVER (
  PARTITION BY origurl ORDER BY term_count DESC, content_length DESC, ord) = 1""",
    "master_corpus": f"""WITH {CORPUS}, {_CORPUS_LINKS} SELECT ord, origurl, url, status, title, ptid,
  post_title, content_length, term_count, sha256(text) AS sha, {_joined('languages')},
  {_PAGE_COLUMNS} FROM corpus LEFT JOIN listed USING (ord)""",
    "corpus_order": f"""WITH {CORPUS} SELECT origurl, row_number() OVER (ORDER BY origurl) - 1 AS row_no,
  row_number() OVER (ORDER BY origurl) - 1 AS place FROM corpus""",
    "corpus_roundtrip": f"""WITH {CORPUS}, {_CORPUS_LINKS}
SELECT ord, ptid, title, sha256(text) AS sha, {_PAGE_COLUMNS}
FROM corpus LEFT JOIN listed USING (ord)""",
    "label_records": f"""WITH {CORPUS}, {_LABEL_SIMPLE}
SELECT to_json({{'ptid': ptid, 'text': s.text, 'post_title': post_title, 'languages': languages,
  'term_count': term_count, 'content_length': content_length, 'url': url}})::VARCHAR AS data
FROM corpus JOIN simple s USING (ord)""",
    "label_scan": f"""WITH {CORPUS}, {_LABEL_SIMPLE} SELECT ptid, url, post_title, content_length,
  sha256(s.text) AS sha, {_joined('languages')} FROM corpus JOIN simple s USING (ord)""",
    "export_html": last_per_path(export_name(*_EXPORT, "html"), "text"),
    "export_markdown": last_per_path(
        f"ptid_slug || '/texts/' || {export_name(*_EXPORT, 'md')}", f"{front_matter()} || text"
    ),
    "url_list_out": f"""WITH {LINKS}, shaped AS (
  SELECT post_no, pos, {canonical('url')} AS url FROM links)
SELECT post_no, pos, url FROM shaped
QUALIFY row_number() OVER (PARTITION BY url ORDER BY post_no, pos) = 1""",
    "url_list_scan": f"""WITH {LINKS}, numbered AS (
  SELECT {canonical('url')} AS url, row_number() OVER (ORDER BY post_no, pos) - 1 AS ord FROM links)
SELECT url, min(ord) AS ord FROM numbered GROUP BY url""",
}
ORACLES["post_pages_roundtrip"] = (
    "SELECT dense_rank() OVER (ORDER BY page_idx) - 1 AS page_idx, * EXCLUDE (page_idx)"
    f" FROM ({ORACLES['flatten_posts']})"
)
ORACLES["extract_modes"] = (
    f"SELECT ord, 'fast' AS mode, text FROM ({ORACLES['page_text']})"
    f" UNION ALL SELECT ord, 'remove', text FROM ({ORACLES['page_text_plain']})"
)
