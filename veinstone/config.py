"""Domain constants: thresholds, categories, word lists. Another city or register needs other values, no other code."""

from __future__ import annotations

from dataclasses import dataclass

# Legal forms (folded), words of no distinction, street types, social and booking hosts, words in addresses of policy pages.
LEGAL_FORMS = (
    "uzdaroji akcine bendrove", "akcine bendrove", "mazoji bendrija", "individuali imone", "viesoji istaiga", "tikroji ukine bendrija", "komanditine ukine bendrija", "zemes ukio bendrove",
    "kooperatine bendrove", "zuvininkystes bendrove", "asociacija", "uab", "ab", "mb", "ii", "vsi", "tub", "kub", "zub", "ltd", "ou", "sia", "oy", "gmbh",
)
CITY_WORDS = ("vilnius", "vilniuje", "vilniaus", "lt", "lietuva")
COMMON_WORDS = (
    "uab mb ii vsi ab lt vilnius vilniuje vilniaus lietuva the and ir de la by nr g biuras parduotuve dirbtuves garazas cechas kabinetas paviljonas namai patalpa patalpos sandelis padalinys filialas "
    "gamybine prekybos vieta taskas kioskas remonto paslaugu paslaugos buveine administracija autoplovykla gamyba biuro pastatas salone"
).split()
STREET_TYPES = {
    "g": "g", "gatve": "g", "pr": "pr", "prospektas": "pr", "al": "al", "aleja": "al", "pl": "pl", "plentas": "pl", "skg": "skg", "skersgatvis": "skg", "a": "a", "aikste": "a", "kel": "kel",
    "kelias": "kel", "tak": "tak", "takas": "tak", "krant": "krant", "krantine": "krant", "skv": "skv", "skveras": "skv", "aklg": "aklg", "akligatvis": "aklg",
}
SKIP_HOSTS = (
    "facebook. instagram. treatwell. trea.tw trw.page.link fresha. booksy. linktr.ee wolt. bolt. tiktok. youtube. google. goo.gl grozionamai. salonized. rekvizitai. nevaziuoja. imones.lt manoremontas. wixsite. business.site g.page"
).split()
POLICY_WORDS = ("privat", "privacy", "taisykl", "terms", "salyg", "sąlyg", "duomen")
INACTIVE_STATUS, INACTIVE_FORMS, OWNER_FORMS = (5, 6, 7, 9, 26), (260, 270, 700, 760, 950), (960, 810)


# Fixed values below: listing types, activity-code prefixes and descriptive words of the categories, and scoring thresholds.
@dataclass(frozen=True)
class Category:
    """Listing types and activity-code prefixes of a category, and words that describe it rather than a business."""

    types: tuple[str, ...]
    codes: tuple[str, ...]
    words: tuple[str, ...]


CATEGORIES = {
    "hair_beauty": Category(
        ("hair_salon", "barber_shop", "beauty_salon", "nail_salon", "hair_care", "beautician"),
        ("96.02", "96.21", "96.22", "96.23"),
        tuple("kirpykla kirpyklos kirpejas kirpeja barbershop barber shop grozio salonas salon studija studio nagu manikiuro beauty hair nails spa kosmetologija kosmetologijos centras".split()),
    ),
    "nightlife": Category(
        ("bar", "pub", "night_club", "cocktail_bar", "wine_bar", "lounge_bar", "sports_bar", "karaoke", "dance_hall", "bar_and_grill", "gastropub", "irish_pub", "brewpub", "beer_garden", "hookah_bar"),
        ("56.30", "56.10", "56.11", "56.12", "56.21", "56.29", "93.29", "93.21"),
        tuple("baras bar baaras pub pubas klubas club naktinis night kokteiliu cocktail vyno wine alaus beer restoranas restaurant kavine cafe lounge karaoke bistro grill".split()),
    ),
    "auto": Category(
        ("car_wash", "car_repair", "tire_shop"),
        ("45.20", "95.31", "95.32"),
        tuple("autoservisas autoserviso servisas service auto automobiliu plovykla plovimas savitarnos savitarna car wash remontas padangos padangu kebulu dazymas vilniuje vilnius centras".split()),
    ),
}


@dataclass(frozen=True)
class Thresholds:
    """Scoring thresholds. ``strict``: every entity that is no lead gets a hold reason, and an unknown gap never leads."""

    min_reviews: int = 30
    extreme_factor: float = 2.5
    low_rating: float = 3.5
    high_rating: float = 4.8
    busy: float = 0.6
    busy_extreme: float = 0.8
    min_peers: int = 8
    near_zero_tax: float = 500.0
    near_zero_revenue: float = 5000.0
    vat_revenue: float = 45000.0
    gap_ratio: float = 3.0
    capacity: int = 20
    strict: bool = False


# Fixed values of the area search: results of one search, its least and most radius in metres, metres to a degree, results that a child cell is meant to have, most cells a side of a split.
MOST_RESULTS, LEAST_RADIUS_M, MOST_RADIUS_M, METRES_PER_DEGREE, RESULTS_PER_CELL, MOST_FAN_OUT = 20, 75.0, 50_000.0, 111_320.0, 12, 6

# Fixed values of the site walk: pages of one site, and what an address or label of a page with a company's details holds.
MOST_PAGES = 4
LINK_HINTS = ("kontakt", "contact", "rekvizit", "apie", "about", "privat", "privacy", "taisykl", "terms", "duomen", "slapuk", "cookie", "salyg", "sąlyg", "imone", "įmonė", "company")
