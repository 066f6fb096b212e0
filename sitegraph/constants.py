"""Values that must be these for the results to be right."""

# Tokens of legal forms and of titles and connectors that a name key leaves out.
LEGAL_FORM_TOKENS = [
    "gmbh", "ggmbh", "gesmbh", "mbh", "ag", "kg", "kgaa", "ohg", "ug", "ek", "ev",
    "se", "gbr", "eg", "cokg", "co", "inc", "ltd", "llc", "haftungsbeschraenkt",
    "gemeinnuetzige", "gemeinnuetzig",
]
NAME_NOISE_TOKENS = ["dr", "med", "dent", "vet", "dipl", "ing", "inh", "prof", "und", "u", "and"]

# The order in which sources win a field.
SOURCE_PRIORITY = ["osm", "ied", "abwaerme", "mastr", "overture", "fsq", "handelsregister"]

# Matching of names and places (metres, per cent, characters).
GRID_M, GRID_SPAN = 100.0, 40
NEAR_M, NEAR_RATIO = 50.0, 80.0
SAME_M, SAME_RATIO = 100.0, 95.0
SHARED_TOKENS, SHARED_CHARS, SPELLING_RATIO = 2, 8, 90.0
CONTAIN_TOKENS, CONTAIN_RATIO = 2, 70.0

# Weights of the confidence score, and its cap for coarse positions.
CONFIDENCE_WEIGHTS = {
    "multi_source": 0.30, "has_website": 0.15, "has_address": 0.20,
    "has_polygon": 0.15, "has_phone": 0.10, "has_area": 0.10,
}
COARSE_CAP = 0.3

# What makes a row industrial.
INDUSTRIAL_SOURCES = ["ied", "abwaerme", "mastr"]
INDUSTRIAL_TAGS = {
    "landuse": ["industrial", "quarry", "port", "depot", "railway", "landfill"],
    "man_made": ["works", "kiln", "wastewater_plant", "water_works"],
    "industrial": ["factory", "oil", "mine", "warehouse", "port", "scrap_yard", "slaughterhouse", "depot"],
    "power": ["plant"],
    "craft": ["metal_construction", "electronics", "joinery"],
}
INDUSTRIAL_TAGS_NAMED = {
    "power": ["generator", "substation"],
    "man_made": ["storage_tank", "silo", "pipeline", "chimney", "gasometer", "mineshaft", "petroleum_well", "pumping_station"],
}

# Words of a registered purpose that tell industry, and those that tell against it.
OBJECTIVE_KEYWORDS = [
    "herstellung", "produktion", "fertigung", "verarbeitung", "erzeugung", "recycling",
    "entsorgung", "abfall", "kraftwerk", "energieerzeugung", "stromerzeugung", "windpark",
    "solarpark", "photovoltaik", "biogas", "raffinerie", "giesserei", "walzwerk", "schmiede",
    "brauerei", "molkerei", "schlacht", "muehle", "saegewerk", "druckerei", "chemie",
    "pharma", "metallbau", "maschinenbau", "anlagenbau", "schiffbau", "werft", "bergbau",
    "steinbruch", "kies", "zement", "beton", "asphalt", "logistik", "spedition",
    "lagerung", "hafen", "wasserversorgung", "abwasser", "fernwaerme",
]
OBJECTIVE_EXCLUDE = [
    "verwaltung von", "beteiligung", "vermietung", "immobilien", "grundstueck", "holding",
    "handel mit", "grosshandel", "einzelhandel", "vertrieb von", "beratung", "vermittlung",
    "softwareentwicklung", "software", "planung", "ingenieur", "architekt",
]

# Learned classes of hosts and what is cut from addresses.
CHAIN_ROWS, DIRECTORY_ROWS, DIRECTORY_NAMES, DIRECTORY_BRAND = 20, 100, 0.9, 0.3
TRACKING = ["utm_", "fbclid", "gclid", "mc_cid", "mc_eid", "ref"]

# Bounds of plausible positions and areas.
LAT_BOUNDS, LON_BOUNDS, AREA_MAX_M2 = (45.0, 56.0), (4.0, 17.0), 5e7

# Rarity of shared tokens that a score of 80 to 89 needs, one token or two.
IDF_RARE, IDF_COMMON = 11.0, 9.0
# The register sources and the kinds of match, best first.
REGISTER_SOURCES = ["hr2022", "gleif", "hr2019"]
MATCH_RANKS = ["name_plz_street", "name_plz", "name_city"]

# Words that tell nothing about a firm in a search for its site, and in a host's label.
GENERIC_WORDS = [
    "gmbh", "und", "der", "die", "das", "von", "fuer", "mit", "bei", "am", "im", "an",
    "shop", "service", "center", "haus", "praxis", "buero", "stadt", "bremen", "hamburg",
    "kiosk", "apotheke", "baeckerei", "restaurant", "hotel", "cafe", "bar", "imbiss",
    "friseur", "salon", "studio", "markt", "laden", "werkstatt", "gaststätte", "gaststaette",
]
TRADE_WORDS = [
    "entsorgung", "online", "group", "gruppe", "germany", "deutschland", "international", "industrie",
    "industries", "technik", "technologie", "logistik", "logistics", "energie", "energy", "solar",
    "metall", "stahl", "bau", "handel", "consulting", "systems", "system", "service", "services",
    "recycling", "umwelt", "transport", "spedition", "werft", "werk", "werke", "gmbh", "shop", "web",
    "immobilien", "holding", "beteiligung", "beteiligungen", "verwaltung", "vermietung", "grundstueck",
    "grundstuecke", "asset", "management", "invest", "capital", "partner", "partners", "projekt", "projekte",
    "umspannwerk", "gleichrichterwerk", "blockheizkraftwerk", "klaeranlage", "zentralklaeranlage", "pumpwerk",
    "wasserwerk", "heizwerk", "heizkraftwerk", "trafostation", "tankstelle", "halle", "lager", "lagerhalle",
    "gewerbegebiet", "industriegebiet", "industriepark", "gewerbepark", "bahnhof", "hafen", "terminal",
    "kraftwerk", "station", "anlage", "betrieb", "zentrale", "niederlassung", "filiale", "standort",
    "nord", "sued", "ost", "west", "mitte", "neu", "alt", "gross", "klein", "ober", "unter",
]
LABEL_SUFFIXES = [
    "gmbh", "kg", "ag", "ug", "ohg", "gbr", "ev", "shop", "online", "24", "group", "gruppe", "web", "home",
    "de", "germany", "deutschland", "service", "services", "logistik", "logistics", "technik", "bau",
    "bremen", "bremerhaven", "hb", "nord", "north", "official", "site", "portal", "info", "net",
]
QUERY_WORDS = [
    "gmbh", "impressum", "und", "der", "die", "das", "co", "kg", "ag", "ug", "ohg", "gbr", "ev", "e.v.", "str", "strasse",
    "stadt", "haus", "shop", "service", "group", "gruppe", "germany", "deutschland", "international", "industrie",
]

# Hosts of listings, profiles and parcel shops, of networks whose pages are a firm's own,
# hosts below a listing that are a firm's own, and words of a label that name no brand.
SOCIAL_HOSTS = [
    "facebook.com", "fb.com", "fb.me", "instagram.com", "linktr.ee", "twitter.com", "x.com",
    "linkedin.com", "xing.com", "youtube.com", "youtu.be", "tiktok.com", "pinterest.com",
    "pinterest.de", "threads.net", "wa.me", "whatsapp.com", "t.me", "telegram.me", "vimeo.com",
    "flickr.com", "tumblr.com", "snapchat.com", "twitch.tv", "discord.gg", "discord.com", "facebook.de", "m.me",
]
PARCEL_HOSTS = ["paketshop.myhermes.de", "myhermes.de", "dpd.com", "gls-pakete.de", "gls-group.eu", "ups.com", "fedex.com", "packstation.de"]
OWN_HOSTS = ["sites.google.com", "business.site", "jimdosite.com", "jimdofree.com"]
SEARCH_HOSTS = ["wikipedia.org", "wikidata.org", "openstreetmap.org", "google.com", "google.de", "bing.com"]
BRAND_STOP = [
    "de", "com", "net", "org", "eu", "www", "online", "vor", "ort", "agentur", "betreuer",
    "shop", "portal", "web", "service", "filialen", "standorte", "stores", "store", "hotel",
    "hotels", "markt", "maerkte", "gesundheit", "group", "gruppe", "info", "app", "home",
    "mein", "meine", "dein", "deine", "unser",
]
# The words of a link to an imprint, the best first.
IMPRINT_WORDS = [
    "impressum", "imprint", "anbieterkennzeichnung", "rechtliche-hinweise", "rechtliche hinweise",
    "rechtliches", "legal-notice", "legal notice", "legalnotice", "legal", "kontakt", "contact",
]

# kW that a unit needs by kind, the kinds that only consume, the states in operation.
FLOOR_KW = {"solar": 100.0, "storage": 100.0, "wind": 50.0, "biomass": 50.0, "hydro": 50.0, "combustion": 50.0, "gsgk": 50.0}
CONSUMERS = ["gas_consumption", "electricity_consumption"]
IN_OPERATION = ["In Betrieb", "InBetrieb", "35"]
# Business types by words of an industry section's label, the first that it holds.
SECTION_TYPES = [
    ("energieversorgung", "power"), ("verarbeitendes gewerbe", "industrial"), ("bergbau", "industrial"),
    ("wasserversorgung", "industrial"), ("land- und forstwirtschaft", "industrial"), ("verkehr und lagerei", "industrial"),
    ("baugewerbe", "craft"), ("handel", "shop"), ("gastgewerbe", "amenity"), ("gesundheits", "amenity"),
    ("erziehung", "amenity"), ("kunst", "amenity"), ("sport", "amenity"), ("abschnitt", "office"),
]
# Chapters of the activity list, and bands of heat in MWh a year.
ACTIVITY_GROUPS = {"1": "energy", "2": "metals", "3": "minerals", "4": "chemicals", "5": "waste", "6": "other"}
HEAT_BANDS = [(1_000, "< 1 GWh/a"), (10_000, "1–10 GWh/a"), (100_000, "10–100 GWh/a")]
# Columns that are never published.
PRIVATE_COLUMNS = ["email", "geometry"]

# Words of a page that is for sale.
PARKED_WORDS = [
    "domain is for sale", "domain kaufen", "diese domain steht zum verkauf", "domain zu verkaufen",
    "parked", "sedoparking", "this domain", "buy this domain", "domain-parking", "domain parking",
]
