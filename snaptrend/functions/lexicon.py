"""Fixed values the results depend on, and the stop-word list built from them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TopicRule:
    """One macro topic: its id, display name and keywords in rule order."""

    topic_id: str
    name: str
    keywords: tuple[str, ...]


# The built-in macro topics. Order matters, it breaks score ties.
DEFAULT_TOPIC_RULES: tuple[TopicRule, ...] = (
    TopicRule("tourism", "Turismo / Ciudad", (
        "turismo", "tourism", "hotel", "hoteles", "hotels", "hospedaje", "aeropuerto", "airport",
        "visitantes", "visitors", "travel", "viaje", "viajes", "comida", "restaurante",
        "restaurantes", "monterrey", "nuevo leon", "city", "ciudad",
    )),
    TopicRule("teams", "Selecciones / Partidos", (
        "seleccion", "seleccion mexicana", "national team", "mexico", "world cup", "fifa",
        "partido", "partidos", "match", "matches", "grupo", "group stage", "rival", "rivales",
        "fans", "fanaticos", "futbol",
    )),
    TopicRule("stadium", "Estadio / Sede", (
        "estadio", "stadium", "bbva", "estadio bbva", "gigante de acero", "sede", "venue",
        "host venue", "cancha", "rayados", "capacidad",
    )),
    TopicRule("fan_fest", "Fan Fest", (
        "fan fest", "fanfest", "festival", "fiesta", "macrofest", "evento", "evento gratuito",
        "free event", "watch party", "artistas", "concierto", "transmision",
    )),
    TopicRule("tickets", "Boletos", (
        "boleto", "boletos", "ticket", "tickets", "entrada", "entradas", "precio", "precios",
        "price", "prices", "sale", "venta", "reventa", "disponibilidad", "fases de venta",
    )),
    TopicRule("infrastructure", "Infraestructura", (
        "obra", "obras", "infraestructura", "infrastructure", "remodelacion", "renovation",
        "construccion", "construction", "metro", "transporte", "trafico", "traffic", "movilidad",
        "transportation", "transit", "parking", "estacionamiento", "rutas", "route", "routes",
        "seguridad", "security", "safety", "policia", "police", "operativo", "aeropuerto",
    )),
)

# Catch-all topic, method names and source labels of a classification.
CATCH_ALL_ID = "other"
CATCH_ALL_NAME = "Otros"
CATCH_ALL_SUB_ID = "other__otros"
METHOD_RULES = "macro_keyword_rules_v2"
METHOD_TFIDF = "macro_tfidf_fallback_v2"
METHOD_NONE = "fallback"
MATCHED_SOURCE = "title,description,tags,search_query,comments"
MATCHED_NONE = "none"
DEFAULT_PHRASE = "conversacion especifica"
DEFAULT_SUB_NAME = "Conversacion especifica"
DEFAULT_SLUG = "topic"
VIDEO_URL_PREFIX = "https://www.youtube.com/watch?v="
LOCAL_ZONE = "America/Monterrey"

# Terms whose casing is restored in displayed phrases.
PROTECTED_TERMS: dict[str, str] = {
    "monterrey": "Monterrey",
    "estadio bbva": "Estadio BBVA",
    "bbva": "BBVA",
    "fifa": "FIFA",
    "fan fest": "Fan Fest",
    "fanfest": "Fan Fest",
    "rayados": "Rayados",
    "tigres": "Tigres",
    "seleccion mexicana": "Seleccion Mexicana",
    "nuevo leon": "Nuevo Leon",
}

# Spanish stop words.
SPANISH_STOP_WORDS = (
    "a", "al", "algo", "algunas", "algunos", "ante", "antes", "como", "con", "contra", "cual",
    "cuando", "de", "del", "desde", "donde", "durante", "e", "el", "ella", "ellas", "ellos", "en",
    "entre", "era", "eran", "eres", "es", "esa", "esas", "ese", "eso", "esos", "esta", "estaba",
    "estado", "estan", "estar", "este", "esto", "estos", "fue", "fueron", "ha", "han", "hasta",
    "hay", "la", "las", "le", "les", "lo", "los", "mas", "me", "mi", "mis", "muy", "no", "nos", "o",
    "para", "pero", "por", "que", "se", "ser", "si", "sin", "sobre", "su", "sus", "tambien", "te",
    "tiene", "todo", "todos", "tu", "un", "una", "unas", "uno", "unos", "y", "ya",
)

# Words too common in this domain to tell topics apart.
DOMAIN_STOP_WORDS = (
    "mundial", "mundial2026", "world", "cup", "copa", "mundo", "2026", "video", "videos", "shorts",
    "youtube", "monterrey", "mexico", "nuevo", "leon", "fifa",
)

# The stop word list of the Glasgow information retrieval group, which text mining
# libraries commonly ship as the English one.
ENGLISH_STOP_WORDS = (
    "a", "about", "above", "across", "after", "afterwards", "again", "against", "all", "almost",
    "alone", "along", "already", "also", "although", "always", "am", "among", "amongst", "amoungst",
    "amount", "an", "and", "another", "any", "anyhow", "anyone", "anything", "anyway", "anywhere",
    "are", "around", "as", "at", "back", "be", "became", "because", "become", "becomes", "becoming",
    "been", "before", "beforehand", "behind", "being", "below", "beside", "besides", "between",
    "beyond", "bill", "both", "bottom", "but", "by", "call", "can", "cannot", "cant", "co", "con",
    "could", "couldnt", "cry", "de", "describe", "detail", "do", "done", "down", "due", "during",
    "each", "eg", "eight", "either", "eleven", "else", "elsewhere", "empty", "enough", "etc",
    "even", "ever", "every", "everyone", "everything", "everywhere", "except", "few", "fifteen",
    "fifty", "fill", "find", "fire", "first", "five", "for", "former", "formerly", "forty", "found",
    "four", "from", "front", "full", "further", "get", "give", "go", "had", "has", "hasnt", "have",
    "he", "hence", "her", "here", "hereafter", "hereby", "herein", "hereupon", "hers", "herself",
    "him", "himself", "his", "how", "however", "hundred", "i", "ie", "if", "in", "inc", "indeed",
    "interest", "into", "is", "it", "its", "itself", "keep", "last", "latter", "latterly", "least",
    "less", "ltd", "made", "many", "may", "me", "meanwhile", "might", "mill", "mine", "more",
    "moreover", "most", "mostly", "move", "much", "must", "my", "myself", "name", "namely",
    "neither", "never", "nevertheless", "next", "nine", "no", "nobody", "none", "noone", "nor",
    "not", "nothing", "now", "nowhere", "of", "off", "often", "on", "once", "one", "only", "onto",
    "or", "other", "others", "otherwise", "our", "ours", "ourselves", "out", "over", "own", "part",
    "per", "perhaps", "please", "put", "rather", "re", "same", "see", "seem", "seemed", "seeming",
    "seems", "serious", "several", "she", "should", "show", "side", "since", "sincere", "six",
    "sixty", "so", "some", "somehow", "someone", "something", "sometime", "sometimes", "somewhere",
    "still", "such", "system", "take", "ten", "than", "that", "the", "their", "them", "themselves",
    "then", "thence", "there", "thereafter", "thereby", "therefore", "therein", "thereupon",
    "these", "they", "thick", "thin", "third", "this", "those", "though", "three", "through",
    "throughout", "thru", "thus", "to", "together", "too", "top", "toward", "towards", "twelve",
    "twenty", "two", "un", "under", "until", "up", "upon", "us", "very", "via", "was", "we", "well",
    "were", "what", "whatever", "when", "whence", "whenever", "where", "whereafter", "whereas",
    "whereby", "wherein", "whereupon", "wherever", "whether", "which", "while", "whither", "who",
    "whoever", "whole", "whom", "whose", "why", "will", "with", "within", "without", "would", "yet",
    "you", "your", "yours", "yourself", "yourselves",
)


def default_stop_words() -> list[str]:
    """English, Spanish and domain stop words together."""
    return sorted({*ENGLISH_STOP_WORDS, *SPANISH_STOP_WORDS, *DOMAIN_STOP_WORDS})
