"""Countries, currencies and subdivisions. Codes come from the JVM's ISO table; names that differ from its English ones stand here."""

from __future__ import annotations

import re
from functools import lru_cache

# Names of countries by two-letter code, where the JVM's English name is another or depends on its version.
NAMES = {
    "AG": "Antigua and Barbuda",
    "BA": "Bosnia and Herzegovina",
    "BL": "Saint Barthélemy",
    "BQ": "Bonaire, Sint Eustatius and Saba",
    "CC": "Cocos (Keeling) Islands",
    "CD": "Democratic Republic of the Congo",
    "CG": "Congo",
    "CI": "Côte d'Ivoire",
    "CV": "Cabo Verde",
    "CZ": "Czechia",
    "FK": "Falkland Islands (Malvinas)",
    "FM": "Micronesia, Federated States of",
    "GS": "South Georgia and the South Sandwich Islands",
    "HK": "Hong Kong",
    "HM": "Heard Island and McDonald Islands",
    "KN": "Saint Kitts and Nevis",
    "LC": "Saint Lucia",
    "MF": "Saint Martin (French part)",
    "MK": "North Macedonia",
    "MM": "Myanmar",
    "MO": "Macao",
    "PM": "Saint Pierre and Miquelon",
    "PN": "Pitcairn",
    "PS": "Palestine",
    "SH": "Saint Helena, Ascension and Tristan da Cunha",
    "SJ": "Svalbard and Jan Mayen",
    "ST": "Sao Tome and Principe",
    "SX": "Sint Maarten (Dutch part)",
    "SZ": "Eswatini",
    "TC": "Turks and Caicos Islands",
    "TR": "Türkiye",
    "TT": "Trinidad and Tobago",
    "UM": "United States Minor Outlying Islands",
    "VA": "Holy See",
    "VC": "Saint Vincent and the Grenadines",
    "VG": "Virgin Islands, British",
    "VI": "Virgin Islands, U.S.",
    "WF": "Wallis and Futuna",
}
# Other names of countries.
ALIASES = {
    "AE": ("Abu Dhabi", "Dubai", "U.A.E.", "UAE"),
    "AT": ("Osterreich", "Österreich"),
    "BA": ("Bosnia",),
    "BO": ("Bolivia, Plurinational State of",),
    "BR": ("Brasil",),
    "BN": ("Brunei Darussalam",),
    "CH": ("Schweiz", "Suisse"),
    "CN": ("Mainland China", "PRC"),
    "CI": ("Ivory Coast",),
    "CD": ("Congo, The Democratic Republic of the", "Congo-Kinshasa", "DRC"),
    "CG": ("Congo-Brazzaville",),
    "CV": ("Cape Verde",),
    "CZ": ("Czech Republic",),
    "DE": ("Deutschland",),
    "DK": ("Danmark",),
    "ES": ("Espana", "España"),
    "FI": ("Suomi",),
    "GB": ("Britain", "England", "Great Britain", "Northern Ireland", "Scotland", "U.K.", "UK", "Wales"),
    "HK": ("Hong Kong SAR",),
    "IN": ("Bharat",),
    "IE": ("Eire", "Republic of Ireland"),
    "IR": ("Iran, Islamic Republic of",),
    "IT": ("Italia",),
    "JP": ("Nippon",),
    "KR": ("Korea", "Korea, Republic of", "Republic of Korea"),
    "LA": ("Lao People's Democratic Republic",),
    "MO": ("Macau",),
    "MD": ("Moldova, Republic of",),
    "MX": ("México",),
    "MK": ("Macedonia",),
    "MM": ("Burma",),
    "NL": ("Holland", "Nederland", "The Netherlands"),
    "NO": ("Norge",),
    "PL": ("Polska",),
    "KP": ("Korea, Democratic People's Republic of",),
    "PS": ("Palestine, State of",),
    "RU": ("Russian Federation",),
    "SE": ("Sverige",),
    "SZ": ("Swaziland",),
    "SY": ("Syrian Arab Republic",),
    "TL": ("East Timor",),
    "TR": ("Turkey",),
    "TW": ("Taiwan, Province of China",),
    "TZ": ("Tanzania, United Republic of",),
    "US": ("America", "U.S.", "U.S.A.", "US of A", "USA", "United States of America"),
    "VA": ("Holy See (Vatican City State)", "Vatican", "Vatican City"),
    "VE": ("Venezuela, Bolivarian Republic of",),
    "VN": ("Viet Nam",),
}
# Countries by the currency that local pay is stated in; others have none.
CURRENCY_COUNTRIES = {
    "EUR": "AD AT BE CY DE EE ES FI FR GR HR IE IT LT LU LV MC ME MT NL PT SI SK SM VA".split(),
    "USD": "EC GU PA PR SV TL US VI ZW".split(),
    "CHF": ["CH", "LI"],
    **{c: [k] for k, c in {
        "AL": "ALL", "AE": "AED", "AR": "ARS", "AM": "AMD", "AU": "AUD", "AZ": "AZN", "BD": "BDT", "BG": "BGN", "BH": "BHD", "BA": "BAM", "BY": "BYN", "BR": "BRL",
        "CA": "CAD", "CL": "CLP", "CN": "CNY", "CO": "COP", "CR": "CRC", "CZ": "CZK", "DK": "DKK", "DO": "DOP", "EG": "EGP", "ET": "ETB", "GB": "GBP", "GE": "GEL",
        "GH": "GHS", "GT": "GTQ", "HK": "HKD", "HU": "HUF", "ID": "IDR", "IN": "INR", "IS": "ISK", "IL": "ILS", "JO": "JOD", "JP": "JPY", "KZ": "KZT", "KE": "KES",
        "KR": "KRW", "KW": "KWD", "LB": "LBP", "LK": "LKR", "MA": "MAD", "MD": "MDL", "MX": "MXN", "MK": "MKD", "MY": "MYR", "NG": "NGN", "NO": "NOK", "NP": "NPR",
        "NZ": "NZD", "OM": "OMR", "PK": "PKR", "PE": "PEN", "PH": "PHP", "PL": "PLN", "QA": "QAR", "RO": "RON", "RU": "RUB", "SA": "SAR", "SG": "SGD", "RS": "RSD",
        "SE": "SEK", "TH": "THB", "TN": "TND", "TR": "TRY", "TW": "TWD", "TZ": "TZS", "UG": "UGX", "UA": "UAH", "UY": "UYU", "VN": "VND", "ZA": "ZAR",
    }.items()},
}
# Subdivisions by code, of the countries whose places are written with them.
SUBDIVISIONS = {
    "US": {
        "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
        "DC": "District of Columbia", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
        "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota",
        "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico",
        "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "PR": "Puerto Rico",
        "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia",
        "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    },
    "CA": {
        "AB": "Alberta", "BC": "British Columbia", "MB": "Manitoba", "NB": "New Brunswick", "NL": "Newfoundland and Labrador", "NS": "Nova Scotia", "NT": "Northwest Territories",
        "NU": "Nunavut", "ON": "Ontario", "PE": "Prince Edward Island", "QC": "Quebec", "SK": "Saskatchewan", "YT": "Yukon",
    },
    "AU": {
        "ACT": "Australian Capital Territory", "NSW": "New South Wales", "NT": "Northern Territory", "QLD": "Queensland", "SA": "South Australia", "TAS": "Tasmania",
        "VIC": "Victoria", "WA": "Western Australia",
    },
}


def key(text: str | None) -> str:
    return re.sub(r"[^a-z0-9]", "", (text or "").casefold())


class Geo:
    """Lookup tables, a few hundred entries each: names, tokens and currencies of countries, and the country of a subdivision."""

    def __init__(self, countries: list[tuple[str, str, str]]):
        self.names = {code: name for code, _, name in countries}
        self.currencies = {code: c for c, codes in CURRENCY_COUNTRIES.items() for code in codes}
        self.tokens: dict[str, str] = {}
        for code, alpha3, name in countries:
            for t in (code, alpha3, name, *ALIASES.get(code, ())):
                if key(t):
                    self.tokens.setdefault(key(t), code)
        self.parents: dict[str, str] = {}
        for country, rows in SUBDIVISIONS.items():
            for code, name in rows.items():
                for t in (code, name):
                    self.parents.setdefault(key(t), country)


@lru_cache(1)
def load_geo() -> Geo:
    """Tables from java.util.Locale of the active session's JVM and the values above. Call on the driver."""
    from pyspark import SparkContext

    jvm = SparkContext._active_spark_context._jvm
    locale, english, rows = jvm.java.util.Locale, jvm.java.util.Locale.ENGLISH, []
    for code in sorted(locale.getISOCountries()):
        place = jvm.java.util.Locale.Builder().setRegion(code).build()
        rows.append((code, place.getISO3Country(), NAMES.get(code) or place.getDisplayCountry(english)))
    return Geo(rows)
