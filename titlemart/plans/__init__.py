from titlemart.plans.build import MARTS, Built, build_marts, load_and_build
from titlemart.plans.marts import (
    collection_lists,
    company_portfolio,
    company_portfolio_dedup,
    fav_by_genre,
    fav_per_year,
    genres,
    media,
    popular_by_genre,
    popular_per_year,
    production_countries,
    spoken_languages,
)
from titlemart.plans.staging import staged_titles, titles_from_star

__all__ = [
    "MARTS",
    "Built",
    "build_marts",
    "collection_lists",
    "company_portfolio",
    "company_portfolio_dedup",
    "fav_by_genre",
    "fav_per_year",
    "genres",
    "load_and_build",
    "media",
    "popular_by_genre",
    "popular_per_year",
    "production_countries",
    "spoken_languages",
    "staged_titles",
    "titles_from_star",
]
