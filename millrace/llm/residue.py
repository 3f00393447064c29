"""Template residue, filler and error pages (p6): likelihood ratios of character n-gram models.

Three models of character 4-grams are fitted: filler, and error and script notices (from fixed seed texts, written from
public knowledge: the classical filler passages, the reason phrases of HTTP, and the wording of servers, browsers and content
systems), and natural prose (counted over all paragraphs of the corpus; the counts are scaled to the weight of ``FIT_PAGES``
pages, so that smoothing weighs the same in a corpus of any size). Every text is scored by the log ratio of the better residue model to natural prose, summed over windows; windows above the threshold localise
residue. A record is residue if that covers ``COVERAGE`` of its content (what is left without the site's template), if its
headline is residue throughout, or if an unfilled placeholder stands in its headline or sentences as a value, not as
something that is written about.

Defined results: a null or empty headline is no case by itself; a null, empty or blank text is no residue; long texts are
scored whole; of records without content beside the template, those are a case whose template is a notice that only
pages without content carry, such as an error page that the host served many times.
"""

from __future__ import annotations

import re
import unicodedata
from http import HTTPStatus

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.pages import CONTROLS, LONG, LONGEST_UNDER, Page, boilerplate_lines, common_capitals, ends_sentence, hashed_lines, pages_of, with_counts
from millrace.session import table

FIT_PAGES = 600  # pages that the counts of natural prose weigh at most, whatever the pages they are taken from
WINDOW, THRESHOLD = 40, 0.15  # letters of a window; nats a letter by which residue must lead
COVERAGE = 0.35
HEAD_WINDOW = 10  # letters of a headline that must all be residue beside paragraphs
STEPS = 40
K = 32
CHUNK = 50_000  # letters that are screened at once

# Seed texts of filler, from the passages of Cicero that filler is made of, and the usual stand-ins.
FILLER = """Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.
Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.
Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.
Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.
Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam, eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo.
Nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit, sed quia consequuntur magni dolores eos qui ratione voluptatem sequi nesciunt.
Neque porro quisquam est, qui dolorem ipsum quia dolor sit amet, consectetur, adipisci velit, sed quia non numquam eius modi tempora incidunt ut labore et dolore magnam aliquam quaerat voluptatem.
At vero eos et accusamus et iusto odio dignissimos ducimus qui blanditiis praesentium voluptatum deleniti atque corrupti quos dolores et quas molestias excepturi sint occaecati cupiditate non provident.
Vestibulum ante ipsum primis in faucibus orci luctus et ultrices posuere cubilia curae; donec velit neque, auctor sit amet aliquam vel, ullamcorper sit amet ligula.
Lorem ipsum lorem ipsum dolor lorem amet ipsum
asdf asdf jkl jkl asdfghjkl qwerty qwertz zxcvbnm
test test testing this is a test test123 abc abc
blah blah bla bla yada yada foo bar baz qux foobar
xxx xxx xxxx TODO TBD FIXME tbd
Title goes here. Your title here. Headline goes here. Subtitle here
Your text goes here. Enter text here. Type your text here. Add your content here. Insert content here. Body text
This is placeholder text. Placeholder headline. Sample text. Example text only. Dummy text. Dummy content. Replace this text with your own. Default post
This is an example page. Hello world! Welcome to your new site. This is your first post. Edit or delete it, then start writing!
Click here to edit this text. Double click to edit. Add a description. Short description here. Add a title. New article. New page. Untitled. Untitled page. Untitled document. Document1. No title. Default title
Coming soon. More content coming soon. This page is under construction. Content will be added shortly. Text to follow. Description to follow. Watch this space
Lückentext. Beispieltext. Mustertext. Blindtext. Platzhaltertext. Dies ist ein Typoblindtext. Hier steht Ihr Text. Hier Text einfügen. Titel hier eingeben. Inhalt folgt in Kürze. Text folgt. Überschrift. Ohne Titel. Hier entsteht eine neue Seite. Demnächst mehr
Weit hinten, hinter den Wortbergen, fern der Länder Vokalien und Konsonantien leben die Blindtexte.
Texte d'exemple. Texte de remplissage. Faux texte. Votre texte ici. Saisissez votre texte ici. Insérez le titre ici. Titre à remplacer. Contenu à venir. Bientôt disponible. Page en construction. Sans titre. Texte provisoire
Texto de ejemplo. Texto de relleno. Escriba su texto aquí. Inserte el título aquí. Su texto aquí. Título de ejemplo. Contenido próximamente. Próximamente. Página en construcción. Sin título. Texto provisional""".splitlines()
# Seed texts of error pages and notices that scripts are required, in the wording of servers, browsers and
# content systems.
NOTICES = [f"{s.value} {s.phrase}\nError {s.value}: {s.phrase}\n{s.phrase}. {s.description}" for s in HTTPStatus if s >= 400] + """An error occurred while processing your request. Please try again later. Reference number
Sorry, something went wrong. We're working on it. Oops! An unexpected error has occurred.
The page you are looking for does not exist. It may have been moved, renamed or deleted. This page cannot be found.
Sorry, the page you requested could not be found. Check the address for typing errors. Go back to the home page.
Nothing was found at this location. Maybe try a search? This article is no longer available.
The requested URL was rejected. The requested resource could not be found on this server. The server returned an error.
The server encountered an internal error or misconfiguration and was unable to complete your request.
The server is temporarily unable to service your request due to maintenance downtime or capacity problems. Please try again later.
The web server reported a bad gateway error. The upstream server failed to respond. Connection timed out. Gateway timeout
nginx apache server at port 80
Database connection failed. Could not connect to the database. Error establishing a database connection
Warning: Undefined variable on line 12. Fatal error: Uncaught exception: Allowed memory size exhausted in /var/www/html/index.php on line 20
Traceback (most recent call last): File "main.py", line 3, in <module> TypeError: object of type None has no attribute
Exception in thread "main" java.lang.NullPointerException at com.example.Main.run(Main.java:42)
{"error": {"code": 500, "message": "internal server error", "status": "failed", "request_id": "0f3c9a"}}
{"status": 404, "message": "not found", "trace_id": null}
You don't have permission to access this page. Access to this resource is denied. You are not authorized to view this content. Your IP address has been blocked.
You have been rate limited. Too many requests from your address. Slow down and try again in a few minutes.
Your session has timed out. Please sign in again to continue. Please log in to view this page.
This content is not available in your country. This content is unavailable in your location due to legal restrictions.
We are down for scheduled maintenance. We'll be back soon. The site is currently undergoing maintenance.
Please wait while we verify your browser. Checking if the site connection is secure. Verifying you are human. This may take a few seconds. Complete the security check to continue. Please confirm that you are not a robot. Ray ID: 7d3f
DDoS protection. Performance and security. Attention required! One moment, please. Redirecting...
JavaScript is disabled. JavaScript is required to use this site. This site requires JavaScript to run. Please turn on JavaScript in your browser settings and reload the page.
You need to turn on JavaScript to use this application. This page needs JavaScript to work. Enable JavaScript and cookies to continue. To view this content, enable scripts in your browser. Please enable scripts and reload
Your browser does not support scripts. Your browser is out of date. Please upgrade or switch to a supported browser. We've detected that JavaScript is blocked. Loading failed
JavaScript ist deaktiviert. Für diese Seite wird JavaScript benötigt. Schalten Sie JavaScript in Ihrem Browser ein und laden Sie die Seite neu. Diese Anwendung benötigt JavaScript. Bitte erlauben Sie Skripte. Ihr Browser wird nicht unterstützt
Fehler 404. Die Seite wurde nicht gefunden. Die angeforderte Seite konnte leider nicht gefunden werden. Die Adresse ist falsch oder die Seite wurde entfernt. Dieser Artikel ist nicht mehr verfügbar.
Fehler 500. Interner Fehler des Servers. Es ist ein Fehler aufgetreten. Bitte versuchen Sie es später noch einmal. Der Server ist zurzeit nicht erreichbar. Wartungsarbeiten. Zugriff verweigert. Sie haben keine Berechtigung. Bitte melden Sie sich an. Sitzung abgelaufen
JavaScript est désactivé. Ce site nécessite JavaScript. Activez JavaScript dans les réglages de votre navigateur et rechargez la page. Cette page a besoin de scripts. Votre navigateur n'est pas pris en charge
Erreur 404. La page demandée n'existe pas ou a été déplacée. Page non trouvée. Nous ne trouvons pas la page que vous cherchez. Cet article n'est plus disponible.
Erreur 500. Erreur interne du serveur. Une erreur est survenue. Veuillez réessayer plus tard. Le service est momentanément indisponible. Site en maintenance. Accès interdit. Vous n'avez pas l'autorisation. Connectez-vous pour continuer. Session expirée
JavaScript está desactivado. Este sitio necesita JavaScript. Habilite JavaScript en la configuración de su navegador y vuelva a cargar la página. Esta página requiere scripts. Su navegador no es compatible
Error 404. No se encontró la página. La página que busca no existe o ha sido eliminada. No podemos encontrar la página solicitada. Este artículo ya no está disponible.
Error 500. Error interno del servidor. Se ha producido un error. Inténtelo de nuevo más tarde. El servicio no está disponible en este momento. Sitio en mantenimiento. Acceso prohibido. No tiene permiso para ver esta página. Inicie sesión para continuar. La sesión ha expirado""".splitlines()
NOTICES = [x for block in NOTICES for x in block.split("\n")]

# Plain prose, so that a small corpus has a model of it, too.
NATURAL = """The company said on Monday that it had opened a new plant near the city and that about two hundred people would work there by the end of the year.
A story about errors of this kind is easily told, but why they happen, how often, and what they cost is seldom asked; the report tries to answer it.
Scientists found that the river carries less water than it did ten years ago, although more rain has fallen in the mountains since the spring.
She wrote the first of her books about the sea and the people who live by it while teaching at a small school in the north.
Das Unternehmen teilte am Montag mit, dass es in der Nähe der Stadt ein neues Werk eröffnet hat, in dem bis zum Ende des Jahres rund zweihundert Menschen arbeiten sollen.
Forscher haben herausgefunden, dass der Fluss weniger Wasser führt als vor zehn Jahren, obwohl in den Bergen seit dem Frühjahr mehr Regen gefallen ist.
L'entreprise a annoncé lundi qu'elle avait ouvert une nouvelle usine près de la ville, où environ deux cents personnes travailleront d'ici la fin de l'année.
Des chercheurs ont constaté que le fleuve transporte moins d'eau qu'il y a dix ans, bien qu'il soit tombé davantage de pluie dans les montagnes depuis le printemps.
La empresa anunció el lunes que había abierto una nueva planta cerca de la ciudad, en la que trabajarán unas doscientas personas antes de que termine el año.
Los investigadores han comprobado que el río lleva menos agua que hace diez años, aunque desde la primavera ha llovido más en las montañas.""".splitlines()

PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]{1,40}\}\}|\{%[^%\n]{1,40}%\}|<%[^%\n]{1,40}%>|[$#]\{[^{}\n]{1,40}\}|\*\|[^|\n]{1,40}\|\*|@@[^@\s]{1,40}@@|\[\[[^\[\]\n]{1,40}\]\]|\[object Object\]"
    r"|<<[^<>\n]{1,40}>>|&lt;[^&\n]{1,40}&gt;|%[A-Za-z][A-Za-z_. ]{1,30}%|__[A-Za-z][A-Za-z_. |]{1,30}__|\{[A-Za-z][A-Za-z_. ]{1,30}\}|\[(?!sic\b)[A-Za-z][A-Za-z_. ]{1,30}\]|<[A-Za-z][A-Za-z_.]{2,30}>|\bundefined\b|\bNaN\b|\bX{4,}\b"
)
#: Two letters that every placeholder has, but for the bare words.
SIGNS = re.compile(r"[{<$#*@\[&%_][{%<|@\[A-Za-z_]")
WORDS = ("undefined", "NaN", "XXXX")
LATIN = re.compile(r"\b(?:lorem|ipsum)\b", re.I)  # paragraphs with these words are no natural prose
BARE = re.compile(r"^\W*(null|undefined|nan|none|x{3,}|tbd|tk|untitled|title|n/a|test)\W*$", re.I)
# Words of sentences that are about a placeholder and don't suffer from one.
ABOUT = re.compile(
    r"\b(templates?|placeholders?|fields?|prompts?|manual|guide|slide|languages?|engine|means?|word|variables?|syntax|swapped|filled in|marks|printed|tutorial|documentation|docs|tokens?|merge tags?|markup|writes"
    r"|Platzhaltern?|Vorlagen?|Feld|Felder|Handbuch|Anleitung|bedeutet|Wort|Variablen?|modèles?|champs?|manuel|signifie|mot|variables?|gabarit|plantillas?|campos?|marcador|significa|palabra)\b",
    re.I,
)


def _codes() -> np.ndarray:
    out = np.full(0x10000, 30, np.int32)
    for c in range(0x250):
        base = unicodedata.normalize("NFD", chr(c))[0].lower()
        out[c] = 1 + ord(base) - 97 if "a" <= base <= "z" else 27 if base.isdigit() else 0 if chr(c).isspace() else 28 if chr(c) in ".,;:!?'\"-()«»" else 29
    for c in "„“”‘’–—…":
        out[ord(c)] = 28
    return out


CODES = _codes()


def encode(text: str) -> np.ndarray:
    return CODES[np.minimum(points(text), 0xFFFF)]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(codes: np.ndarray) -> np.ndarray:
    """Index of the 4-gram that ends at each letter; the text begins after spaces."""
    p = np.zeros(len(codes) + 3, np.int32)
    p[3:] = codes
    return ((p[:-3] * K + p[1:-2]) * K + p[2:-1]) * K + p[3:]


def counts_of(texts: list[str]) -> np.ndarray:
    """How often each 4-gram occurs in the texts, each of which begins after spaces."""
    out = np.zeros(K**4, np.int64)
    for t in texts:
        np.add.at(out, grams(encode(t)), 1)
    return out


def paragraph_counts(texts: list[str]) -> tuple[np.ndarray, int]:
    """``counts_of`` the paragraphs of some pages, taken together, and the number of pages that have one."""
    out, pages, held, load = np.zeros(K**4, np.int64), 0, [], 0
    for at, text in enumerate(texts, 1):
        own = [x for x in text.split("\n") if len(x) >= LONG]
        pages += bool(own)
        held += [x for x in own if not LATIN.search(x)]
        load += len(text)
        if held and (load >= 20 * CHUNK or at == len(texts)):
            whole = points("\n\n\n".join(held))
            out += np.bincount(grams(CODES[np.minimum(whole, 0xFFFF)])[whole != 10], minlength=K**4)
            held, load = [], 0
    return out, pages


def fit_model(texts: list[str], counted: np.ndarray | None = None) -> np.ndarray:
    """log P(letter | three before) of every 4-gram, interpolated over shorter contexts. ``counted`` is added to the counts."""
    whole = counts_of(texts).astype(np.float64) + (0 if counted is None else counted)
    p = np.full(K, 1.0 / K)
    for n in range(1, 5):
        c = whole.reshape(-1, K**n).sum(0).reshape(-1, K)
        lower = np.tile(p.reshape(-1, K), (c.shape[0] // (p.size // K), 1))
        p = ((c + 4.0 * lower) / (c.sum(1, keepdims=True) + 4.0)).ravel()
    return np.log(p).astype(np.float32)


class Residue:
    """Log ratios of the residue models to natural prose."""

    def __init__(self, natural: list[str], counted: np.ndarray | None = None):
        base = fit_model(NATURAL + natural, counted)
        self.ratios = [np.clip(fit_model(seeds * 3) - base, -3, 3) for seeds in (FILLER, NOTICES)]
        # a window's sum of these is never below either model's; in steps of 1/40, rounded up, to stay in the cache
        self.bound = np.ceil(np.maximum(*self.ratios) * STEPS).astype(np.int8)

    def line(self, text: str) -> float:
        """Nats a letter by which the better residue model leads over a whole line."""
        g = grams(encode(text))
        return max(float(r[g].mean()) for r in self.ratios) if len(g) else 0.0

    def covered(self, text: str) -> int:
        """Letters of ``text`` inside windows that lead by the threshold."""
        g = grams(encode(text))
        if not len(g):
            return 0
        if len(g) <= WINDOW:
            return len(g) if max(float(r[g].mean()) for r in self.ratios) > THRESHOLD else 0
        inside = np.zeros(len(g), bool)
        for r in self.ratios:
            total = np.concatenate([[0.0], np.cumsum(r[g], dtype=np.float64)])
            hot = np.flatnonzero((total[WINDOW:] - total[:-WINDOW]) / WINDOW > THRESHOLD)
            edge = np.zeros(len(g) + 1, np.int32)
            np.add.at(edge, hot, 1)
            np.add.at(edge, hot + WINDOW, -1)
            inside |= np.cumsum(edge[:-1]) > 0
        return int(inside.sum())

    def screen(self, heads: list[str], texts: list[str]) -> list[int]:
        """2 for pages that may be residue, 1 for those that may if their paragraphs are the site's, else 0; 0 only for
        pages that ``is_residue`` can't take: no placeholder, no odd headline, and too few letters in lines with a window
        above the threshold beside paragraphs without one. Pages are scored together, some ``CHUNK`` letters at a time."""
        out, at = [0] * len(texts), 0
        while at < len(texts):
            end, load = at, 0
            while end < len(texts) and (load < CHUNK or end == at):
                load += len(texts[end])
                end += 1
            out[at:end] = self._screened(heads[at:end], texts[at:end])
            at = end
        return out

    def _screened(self, heads: list[str], texts: list[str]) -> list[int]:
        # the headline is scored as a first line; each line after spaces, as on its own
        whole = points("\n\n\n".join((h.replace("\n", " ") + "\n" + t).replace("\n", "\n\n\n") for h, t in zip(heads, texts)))
        codes = CODES[np.minimum(whole, 0xFFFF)]
        breaks = np.flatnonzero(whole == 10)[::3]
        starts, ends = np.concatenate([[0], breaks + 3]), np.concatenate([breaks, [len(codes)]])
        n_lines = np.array([2 + t.count("\n") for t in texts])
        first = np.concatenate([[0], np.cumsum(n_lines)[:-1]])  # the headline's line of each page
        page = np.repeat(np.arange(len(texts)), n_lines)
        g, length = grams(codes), ends - starts
        total = np.zeros(len(g) + 1, np.int64 if len(g) > 1 << 23 else np.int32)
        np.cumsum(self.bound[g], out=total[1:])
        score = total[ends] - total[starts]
        hot = (length > 0) & (length <= WINDOW) & (score > THRESHOLD * STEPS * length)
        if len(g) > WINDOW:
            seen = np.zeros(len(g) - WINDOW + 2, np.int32)
            np.cumsum(total[WINDOW:] - total[:-WINDOW] > int(THRESHOLD * STEPS * WINDOW), out=seen[1:])
            hot |= (length > WINDOW) & (seen[np.maximum(ends - WINDOW + 1, 0)] > seen[np.minimum(starts, len(seen) - 1)])
        odd = (length[first] > 0) & (score[first] > 2 * THRESHOLD * STEPS * length[first])
        body = np.ones(len(page), bool)
        body[first] = False
        add = lambda keep: np.bincount(page[keep], length[keep], minlength=len(texts))
        most, rest = add(hot & body), add(body & ~hot & (length > LONGEST_UNDER))
        doubt = np.where(most > 0, np.where(most >= COVERAGE * (most + rest), 2, 1), 0)
        for k, (h, t) in enumerate(zip(heads, texts)):
            if doubt[k] < 2 and (odd[k] and self.odd_head(h, True) or h and BARE.match(h) or has_placeholder(h) and placeholder_as_value(h) or has_placeholder(t)):
                doubt[k] = 2
        return doubt.tolist()

    def odd_head(self, head: str, alone: bool = False) -> bool:
        """Whether a headline is residue: a bare word that stands for a title, an unfilled placeholder, or residue throughout:
        beside paragraphs (not ``alone``) every short window of it, since articles are written about filler and errors."""
        if BARE.match(head) or has_placeholder(head) and placeholder_as_value(head):
            return True
        g = grams(encode(head))
        if not len(g) or self.line(head) <= 2 * THRESHOLD or self.covered(head) < 0.8 * len(head):
            return False
        return alone or len(head) >= HEAD_WINDOW and any(float(windowed(r[g], HEAD_WINDOW).min()) > 0 for r in self.ratios)


def windowed(x: np.ndarray, size: int) -> np.ndarray:
    """Means of all windows of so many values; of all of them, if they are fewer."""
    total = np.concatenate([[0.0], np.cumsum(x, dtype=np.float64)])
    return (total[size:] - total[:-size]) / size if len(x) > size else total[-1:] / max(1, len(x))


def has_placeholder(text: str) -> bool:
    if any(c in text for c in "{<$#*@[&%_") and SIGNS.search(text) or any(w in text for w in WORDS):
        return PLACEHOLDER.search(text) is not None
    return False


def placeholder_as_value(text: str) -> bool:
    """Whether an unfilled placeholder stands where a value should, in a sentence that isn't about placeholders."""
    for sentence in re.split(r"(?<=[.!?])\s+", text):
        if PLACEHOLDER.search(sentence):
            rest = PLACEHOLDER.sub(" ", sentence)
            if not ABOUT.search(rest):
                return True
    return False


def is_residue(page: Page, model: Residue) -> bool:
    head = page.headline
    if head and model.odd_head(head, not any(len(x) >= LONG for x in page.lines)):
        return True
    residue = natural = 0
    for i, x in enumerate(page.lines):
        k = page.kind[i]
        if k in ("", "T") or x == head and k != "R":
            continue
        if i in page.under:  # without an article below it, a list of stories runs into the residue
            bare = PLACEHOLDER.sub("", x).strip() if has_placeholder(x) else x
            if len(bare) < 4 < len(x) or i not in page.roots and model.covered(x) >= 0.8 * len(x) and model.line(x) > 2 * THRESHOLD:
                residue += len(x)
            continue
        if i in page.labelled and len(x) < LONG and not ends_sentence(x):
            continue
        if has_placeholder(x):
            if placeholder_as_value(x):
                return True
            natural += len(x)
            continue
        got = model.covered(x)
        if got >= 0.5 * len(x):
            if k == "R" and CONTROLS.search(x) and not ends_sentence(x) and model.line(x) < 4 * THRESHOLD:
                continue
            residue += got
        elif k == "U":
            natural += len(x) - got
            residue += got if got >= WINDOW * 2 else 0
    if not residue and not natural:
        return recurring_notice(page, model)
    return residue > 0 and residue >= COVERAGE * (residue + natural)


def recurring_notice(page: Page, model: Residue) -> bool:
    """Whether a page of template alone shows an error page or a notice that recurs on its host: a line of the kind that
    stands where content should be, not on the pages that have content."""
    for i in page.alone:
        x = page.lines[i]
        if page.kind[i] != "T" or i in page.under or i in page.labelled and len(x) < LONG and not ends_sentence(x):
            continue
        if CONTROLS.search(x) and not ends_sentence(x) and model.line(x) < 4 * THRESHOLD:
            continue
        if model.covered(x) >= 0.5 * len(x) and model.line(x) > 2 * THRESHOLD:
            return True
    return False


def natural_counts(news: DataFrame) -> np.ndarray:
    """4-gram counts of the paragraphs of all pages, scaled to ``FIT_PAGES`` pages if there are more. At most K**4 rows come
    to the driver, whatever the corpus."""

    def emit(batches):
        total, pages = np.zeros(K**4, np.int64), 0
        for b in batches:
            got, n = paragraph_counts(b["text"].tolist())
            total, pages = total + got, pages + n
        some = np.flatnonzero(total)
        yield pd.DataFrame({"gram": np.append(some, -1), "n": np.append(total[some], pages)})

    texts = news.select(F.col("content.full_text").alias("text")).filter("text IS NOT NULL")
    rows = texts.mapInPandas(emit, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram, n = rows["gram"].to_numpy(), rows["n"].to_numpy()
    out = np.zeros(K**4)
    out[gram[gram >= 0]] = n[gram >= 0]
    return out * min(1.0, FIT_PAGES / max(1, n[gram < 0].sum()))


def screened_lines(news: DataFrame) -> tuple[DataFrame, DataFrame, object]:
    """pages, their hashed lines with the screen's verdict, and for broadcast the residue models and the corpus' common
    capitalised words: both of bounded size."""
    sc, pages = news.sparkSession.sparkContext, pages_of(news)
    model = Residue([], natural_counts(news))
    shared = sc.broadcast(model)
    lines = hashed_lines(pages, lambda heads, texts: shared.value.screen(heads, texts))
    return pages, lines, sc.broadcast((model, common_capitals(lines)))


def over_pages(counted: DataFrame, shared, emit, schema: str) -> DataFrame:
    """Runs ``emit(news_ids, urls, pages, residue) -> columns`` over batches of pages with their element counts."""
    columns = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches):
        model, common = shared.value
        for b in batches:
            pages, residue = [], []
            for headline, text, marks, counts in zip(b["headline"], b["text"], b["marks"], b["counts"]):
                known = marks is not None
                page = Page(headline if isinstance(headline, str) else "", text if isinstance(text, str) else "", marks.tolist() if known else (), counts.tolist() if known else (), common)
                pages.append(page)
                # a page that only residue beside the site's own paragraphs could make a case
                doubt = page.doubt == 2 or page.doubt == 1 and any(k == "T" and len(x) > LONGEST_UNDER for k, x in zip(page.kind, page.lines))
                residue.append(doubt and is_residue(page, model))
            yield pd.DataFrame(dict(zip(columns, emit(b["news_id"].tolist(), b["url"].tolist(), pages, residue))))

    return counted.select("news_id", "url", "headline", "text", "marks", "counts").mapInPandas(run, schema)


def p6_found(spark, sf_dir: str) -> DataFrame:
    pages, lines, shared = screened_lines(table(spark, sf_dir, "news"))
    # only pages that may be residue meet the element counts, which are taken over all pages
    counted = with_counts(pages, lines, lines.filter("doubt > 0"))
    return over_pages(counted, shared, lambda keys, urls, pages, residue: [[k for k, r in zip(keys, residue) if r]], "news_id long").distinct()


def template_rows(keys, urls, pages, residue):
    rows = [(k, n) for k, page, r in zip(keys, pages, residue) if not r for n in boilerplate_lines(page)]
    return [k for k, _ in rows], [n for _, n in rows]


def template_lines(news: DataFrame) -> DataFrame:
    """news_id, line_no of each line that is no part of its page's article."""
    pages, lines, shared = screened_lines(news)
    return over_pages(with_counts(pages, lines), shared, template_rows, "news_id long, line_no int")


def p1_found(spark, sf_dir: str) -> DataFrame:
    return template_lines(table(spark, sf_dir, "news"))
