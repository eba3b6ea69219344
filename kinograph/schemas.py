"""Explicit schemas of the catalogue's tables and of the JSON replies that feed them."""

from __future__ import annotations

#: One page of a discovery reply.
DISCOVER_PAGE = "results array<struct<id:bigint,vote_count:bigint,popularity:double,release_date:string>>, total_pages int"

#: A movie's detail reply.
MOVIE_DETAIL = (
    "id bigint, title string, original_title string, overview string, tagline string, release_date string, adult boolean, runtime int, "
    "budget bigint, revenue bigint, vote_average double, vote_count bigint, popularity double, original_language string, imdb_id string, "
    "poster_path string, backdrop_path string, genres array<struct<name:string>>, keywords struct<keywords:array<struct<name:string>>>, "
    "credits struct<cast:array<struct<name:string>>,crew:array<struct<name:string,job:string>>>, production_companies array<struct<name:string>>"
)

#: Person numbers come as numbers or as text; as text both are read.
_PERSON = "id:string,name:string,profile_path:string,known_for_department:string,popularity:double"

#: A movie's credits reply.
CREDITS = f"cast array<struct<{_PERSON},character:string,`order`:int>>, crew array<struct<{_PERSON},job:string,department:string>>"

#: One reply of an embedding service.
EMBEDDINGS = "data array<struct<embedding:array<double>,index:int>>"

#: Only the companies of a movie's detail reply.
COMPANIES = "id bigint, production_companies array<struct<name:string>>"
RUNS = "run_id string, run_type string, status string, started_at timestamp, finished_at timestamp, rows_processed bigint, rows_failed bigint, error_message string"
