"""Explicit schemas of the record tables, as DDL."""

# rating and reviewCount mix text and numbers in the wild; they are read as text and cast safely.
ACTIVITY = (
    "url string, title string, name string, description string, city string, price string, currency string, "
    "ld_type string, rating string, reviews string, reviewCount string, highlights array<string>, "
    "featured_reviews array<string>"
)

WIKI_FIELDS = (
    "struct<location:string,country:string,coordinates:string,built:string,architect:string,style:string,height:string>"
)
WIKI_PAGE = (
    "title string, normalized string, tokens array<string>, url string, categories array<string>, abstract string, "
    f"type string, fields {WIKI_FIELDS}, geo_parent array<string>, geo_parent_tokens array<array<string>>"
)

MATCH = "struct<wiki_title:string,wiki_type:string,wiki_abstract:string,wiki_architect:string,wiki_style:string>"
ENRICHED = f"{ACTIVITY}, primary_match {MATCH}, matches array<{MATCH}>"

WIKI_XML = "title string, revision struct<text:string>"
