"""URL functions as Column expressions; each is a pure function of the URL."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gazetta.functions.text import blank, norm_python, norm_search

_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#;]*)(?:;[^?#]*)?(\?[^#]*)?"

# Page kinds by order of interest, social networks, off-topic subdomains, and file types that are no pages.
PRIORITIES = [
    ["equipe_governo", "equipe_de_governo", "estrutura_organizacional"],
    ["gabinete", "prefeito", "vice_prefeito", "secretarias", "secretaria"],
    ["sedecon", "desenvolvimento", "seplan", "planejamento", "financas", "fazenda"],
    ["contato", "fale_conosco"],
    ["servicos", "materia", "noticia", "concursos", "licitacoes", "iptu", "nfe"],
]
NETWORKS = ["facebook.com", "instagram.com", "linkedin.com", "youtube.com"]
SUBDOMAINS = ["://educacao.", "://saude.", "://mambiente.", "://transito.", "://transparencia.", "://sistemas.", "://sisweb."]
FILES = [".pdf", ".doc", ".docx", ".odt", ".ods", ".odp", ".xls", ".xlsx", ".zip", ".rar", ".7z", ".jpg", ".jpeg", ".png", ".gif", ".webp", ".mp4", ".mp3", ".ashx"]
# Beginnings of paths, and parts of queries, that no page of interest has.
PREFIXES = [
    "/noticia", "/noticias", "/evento", "/eventos", "/imprensa", "/blog", "/avaliar", "/category", "/categoria", "/publicacoes", "/publicacao", "/galeria", "/normas-legais", "/documentos",
    "/documento", "/site/tag", "/site/servicos", "/portal/carta-de-servico/servico/", "/portal/carta-servicos/", "/turismo", "/videos", "/faq",
]
QUERIES = [
    "pag=", "page=", "page_no=", "pagina=", "pagina=404", "cat=", "pg=", "p=", "cp=", "start=", "b_start", "export=", "ps_export=", "wpdmc=", "length=", "share=", "servico=", "tipo=", "tipolei=",
    "idnot=", "itemid=", "filename=", "entry=wp_", "mime-type=", "page_id=", "q=noticia", "departamentosearch", "theme=", "ajaxprevent=", "binary=true", "classe=uploadmidia", "processo=viewfile",
    "n5b0", "spb0", "vfb0", "9fb0", "z5b0", "servicos-secretarias", "iprem",
]
# Defaults: the general ones of the parts of paths that no page of interest has. Lists tuned to a
# country's sites run to hundreds; they are rows of a table of rules (``operators.rules``), beside these or in their place.
SEGMENTS = [
    "/page/", "/pagina/", "/category/", "/categoria/", "/account/", "/acessibilidade", "/blog/", "/blogs/", "/aviso/", "/arquivos/", "/audiencias-publicas", "/busca", "/competencias", "/contrato/",
    "/contratos", "/convenios", "/carta-de-servicos", "/dados-abertos", "/documentos", "/download/", "/downloads/", "/despesa", "/diarias", "/e-sic", "/fotos/", "/filtro/", "/folha-pagamento",
    "/homepage", "/hino", "/iptu", "/mapa-do-site", "/lgpd", "/divida-ativa", "/legis/", "/legislacao", "/licitacao/", "/licitacoes", "/links-uteis", "/localizacao", "/mapa-site", "/ouvidoria",
    "/nota-fiscal", "/perguntas-frequentes", "/plano-diretor", "/plano-municipal", "/plano-plurianual", "/publicacoes", "/processo-seletivo", "/portarias/", "/receita", "/requerimentos",
    "/prestacao-de-contas", "/prefeitos-anteriores", "/servicos/", "/servidores", "/terceirizados", "/transparencia/", "/conselho-tutelar", "/escolas/", "/terminal-rodoviario", "/unidades-de-saude",
    "/editais/", "/galeria", "/noticia/", "/noticia", "/noticias/", "/noticias", "/agenda", "/turismo/", "-noticias", "noticias-", "wp-admin", "erro-site", "precatorios", "simbolos", "previdencia",
    "gestao-de-residuos", "almoxarifado", "recursos-humanos", "consulta-publica", "novidade-", "concursos", "comunicados", "central-de-atendimento", "refis", "codigo-tributario", "itbi", "nfs-e",
    "nfse", "/iss", "controle-interno", "igualdade-racial", "/esic", "pagamentos", "podcast", "creas", "direitos-humanos", "desenvolvimento-social", "desenvolvimento_social", "terceiro-setor",
    "guarda-civil", "patrimonio", "diario_oficial", "diario-oficial", "prestacao-de-contas", "esqueci-minha-senha", "/entrar",
]
# Words that make a unit relevant, and those that put it out of scope.
RELEVANT = ["administracao", "desenvolvimento", "empreendedor", "fazenda", "financas", "gabinete", "governo", "industria", "planejamento", "prefeito", "vice"]
OFF_TOPIC = [
    "assistencia", "agricultura", "ambiente", "ambulatorio", "animal", "cidadania", "comunicacao", "conselho", "controladoria", "controlador", "cultura", "defesa_civil", "defesacivil", "demutran",
    "direitos_humanos", "educacao", "esf", "esporte", "eventos", "familia", "habitacao", "infraestrutura", "imprensa", "juridico", "juridicos", "juventude", "lazer", "militar", "meioambiente",
    "meio_ambiente", "mobilidade", "mulher", "obras", "pesca", "procuradoria", "relacoes_institucionais", "saneamento", "seguranca", "servicos_urbanos", "servicos_municipais", "servicos_publicos",
    "saude", "social", "suprimentos", "transito", "transporte", "turismo", "urbanos", "urbanismo", "zeladoria",
]
# Words of links to follow, and standard paths of a site.
KEYWORDS = [
    "prefeito", "vice-prefeito", "gabinete", "secretarias", "secretaria", "equipe", "administração", "contatos", "contato", "fale conosco", "desenvolvimento econômico", "desenvolvimento", "fazenda",
    "finanças", "planejamento", "agência de desenvolvimento", "sala do empreendedor",
]
FALLBACK_PATHS = ["equipe_governo.aspx", "equipe-de-governo", "equipe-governo", "estrutura-organizacional", "secretarias", "secretaria", "gabinete", "prefeito", "contato", "fale-conosco"]
# Verbs of news in a slug, beginnings that a long slug of a unit may have, and states of a site that is up though it turns robots away.
NEWS_VERBS = ["acompanhe", "visita", "lanca", "promove", "estende", "campanha", "obras-na-cidade"]
UNIT_SLUGS = ["secretaria-", "departamento-", "diretoria-", "gabinete-", "sala-do-empreendedor"]
TURNED_AWAY = [401, 403, 406, 429, 503]
MOST_BYTES = 2_000_000


def let(c: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is named; expressions that grow by substitution stay small."""
    return F.transform(F.array(c), then)[0]


def has_any(c: Column, tokens: Iterable[str]) -> Column:
    """One scan for any of the tokens."""
    return c.rlike("|".join(sorted(map(re.escape, tokens))))


def clean_url(c: Column) -> Column:
    """White space out, https where no scheme is, scheme and host in lower case, path at least "/", no parameters or fragment."""

    def rebuilt(full: Column) -> Column:
        def part(i: int) -> Column:
            return F.regexp_extract(full, _PARTS, i)

        return F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), F.coalesce(F.nullif(part(3), F.lit("")), F.lit("/")), part(4))

    def schemed(bare: Column) -> Column:
        full = F.when(bare.rlike("(?i)^[a-z][a-z0-9+.-]*://"), bare).otherwise(F.concat(F.lit("https://"), bare))
        return F.when((bare == "") | F.lower(bare).isin("nan", "none"), "").otherwise(let(full, rebuilt))

    return let(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", ""), schemed)


def host(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(c, _PARTS, 2)), r"^www\.", "")


def path(c: Column) -> Column:
    return F.regexp_extract(c, _PARTS, 3)


def query(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, _PARTS, 4), r"^\?", "")


def url_key(c: Column) -> Column:
    """Scheme-insensitive identity: host without www, path without doubled or trailing slashes, query."""
    short = F.regexp_replace(F.regexp_replace(path(c), "/+$", ""), "/{2,}", "/")
    return F.concat_ws("|", host(c), F.when(short == "", "/").otherwise(short), query(c))


def same_domain(a: Column, b: Column) -> Column:
    """Equal hosts, or the first is a subdomain of the second."""
    return (host(a) == host(b)) | F.endswith(host(a), F.concat(F.lit("."), host(b)))


def root_url(c: Column) -> Column:
    return F.when(F.regexp_extract(c, _PARTS, 2) == "", "").otherwise(F.concat(F.lower(F.regexp_extract(c, _PARTS, 1)), F.lit("://"), F.lower(F.regexp_extract(c, _PARTS, 2)), F.lit("/")))


def is_root(c: Column) -> Column:
    return F.regexp_replace(F.lower(path(c)), "^/+|/+$", "").isin("", "index.php", "index.html", "home", "portal")


def bare_host(c: Column) -> Column:
    """The URL without www; empty where there is none."""
    return F.when(F.regexp_extract(c, _PARTS, 2).startswith("www."), F.regexp_replace(c, r"://www\.", "://")).otherwise("")


def link_priority(c: Column) -> Column:
    text = F.translate(norm_search(c), "-", "_")
    out = F.when(F.lit(False), 0)
    for number, tokens in enumerate(PRIORITIES):
        out = out.when(has_any(text, tokens), number)
    return out.otherwise(len(PRIORITIES))


def unquoted(c: Column) -> Column:
    """Percent escapes resolved; a malformed one leaves the text as it is."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, r"\+", "%2B")), c)


def ignore_reason(c: Column, segments: Iterable[str] = SEGMENTS, hosts: Iterable[str] = (), hits: Column | None = None) -> Column:
    """The first rule by which a URL is no page of interest; null where none holds.

    ``segments``: parts of paths to leave out; ``hosts``: parts of URLs of vendors and single sites to leave out. With ``hits``, the
    kinds of listed rules that hold as ``rules.judge_urls`` found them in a table, no list is read here.
    """
    read = F.struct(F.lower(unquoted(c)).alias("raw"), norm_search(unquoted(path(c))).alias("path"), F.lower(query(c)).alias("query"))
    return let(read, lambda u: let(_scopes(u), lambda v: _first_rule(u, v, segments, hosts, hits)))


def _scopes(u: Column) -> Column:
    last = F.element_at(F.split(F.regexp_replace(u["path"], "/+$", ""), "/"), -1)
    tidy = lambda x: F.translate(x, "-", "_")
    return F.struct(last.alias("last"), tidy(last).alias("scope"), tidy(u["path"]).alias("whole"), tidy(norm_search(unquoted(u["query"]))).alias("query"), (F.length(last) - F.length(F.translate(last, "-", ""))).alias("dashes"))


def _first_rule(u: Column, v: Column, segments: Iterable[str], hosts: Iterable[str], hits: Column | None) -> Column:
    raw, p, asked = u["raw"], u["path"], u["query"]
    last, scope, whole, query_scope, dashes = (v[k] for k in ("last", "scope", "whole", "query", "dashes"))

    def out_of_scope(text: Column) -> Column:
        return has_any(text, OFF_TOPIC) & ~has_any(text, RELEVANT)

    def listed(kind: str, own: Column) -> Column:
        return own if hits is None else F.array_contains(hits, kind)

    unit = has_any(p, ["/secretaria/", "/secretarias/", "/secretariados/"]) | last.startswith("secretaria-")
    units = [t for t in RELEVANT if t not in ("gabinete", "governo", "prefeito", "vice")]
    rules: list[tuple[str, Column]] = [
        ("characters", raw.rlike(r"[<>*]|:3000")),
        ("error text", has_any(raw, ["notice", "trying to get property"])),
        ("subdomain", listed("subdomain", has_any(raw, SUBDOMAINS))),
        ("vendor", listed("host", has_any(raw, [*hosts, "resource.faces"]))),
        ("network", listed("network", has_any(raw, NETWORKS))),
        ("file", listed("file", p.rlike("(" + "|".join(map(re.escape, FILES)) + ")$"))),
        ("address", p.contains("@")),
        ("prefix", listed("prefix", p.rlike("^(" + "|".join(map(re.escape, PREFIXES)) + ")"))),
        ("segment", listed("segment", has_any(p, segments))),
        ("nested", p.rlike("(/conteudo/.*){3}|(/secretaria/.*){2}")),
        ("cabinet", p.contains("/gabinete/") & has_any(p, ["/gabinete/gabinete", "/secretarias/", "/secretaria/"])),
        ("section", p.rlike("/(file|videos|faq)/*$")),
        ("news", has_any(asked, ["noticias.asp", "cont_not", "idsomar="])),
        ("social", raw.contains("desenvolvimento_social") | p.rlike("/desenvolvimento-social/*$")),
        ("dated", p.rlike("^/*[0-9]{4}/+[0-9]{2}(/|$)")),
        ("index", last.isin("pagina-principal", "servicos", "sitemap")),
        ("council", whole.contains("conselho_municipal") & ~p.contains("desenvolvimento")),
        ("off topic unit", unit & out_of_scope(F.concat_ws("?", scope, query_scope))),
        ("off topic", out_of_scope(scope)),
        ("off topic path", whole.rlike("/(" + "|".join(OFF_TOPIC) + ")/") & ~has_any(whole, units)),
        ("off topic query", out_of_scope(query_scope)),
        ("long slug", (dashes >= 5) & ((F.length(last) >= 45) | ~last.rlike("^(" + "|".join(UNIT_SLUGS) + ")"))),
        ("news slug", (dashes >= 3) & has_any(last, NEWS_VERBS)),
        ("query", listed("query", has_any(asked, QUERIES))),
    ]
    out = F.when(F.lit(False), "")
    for reason, holds in rules:
        out = out.when(holds, reason)
    return out


def moved(url: Column, final_url: Column) -> Column:
    """Whether a page that isn't the site's root led to another."""
    return F.coalesce(~blank(final_url) & (clean_url(url) != clean_url(final_url)) & (F.regexp_replace(path(url), "/+$", "") != ""), F.lit(False))


def redirected_off(url: Column, final_url: Column, reason: Column | None = None) -> Column:
    """Whether a page that isn't the site's root led to one that is to be left out; ``reason``: what a table of rules says of that one."""
    return moved(url, final_url) & (ignore_reason(final_url) if reason is None else reason).isNotNull()


def resolve(base: Column, href: Column) -> Column:
    """The address that a link names on the page ``base``, clean and without its fragment; empty for links that aren't pages."""
    return let(F.struct(F.trim(href).alias("h"), clean_url(base).alias("b")), lambda u: _resolved(u["h"], u["b"]))


def _resolved(h: Column, b: Column) -> Column:
    root, folder = F.regexp_replace(root_url(b), "/$", ""), F.regexp_replace(path(b), "[^/]*$", "")
    absolute = h.rlike("(?i)^[a-z][a-z0-9+.-]*:")
    joined = (
        F.when(absolute, h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(b, "^([a-z]+:)", 1), h))
        .when(h.startswith("/"), F.concat(root, h))
        .when(h.startswith("?"), F.concat(root, path(b), h))
        .otherwise(F.concat(root, F.coalesce(F.nullif(folder, F.lit("")), F.lit("/")), h))
    )
    page = ~h.rlike("(?i)^(mailto:|tel:|javascript:|#|$)") & (~absolute | h.rlike("(?i)^https?:"))
    return F.when(F.coalesce(page, F.lit(False)), let(clean_url(joined), _undotted)).otherwise("")


def _undotted(c: Column) -> Column:
    """Steps of a path to itself or to its parent taken."""
    steps = F.aggregate(
        F.split(path(c), "/"),
        F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).when(x == ".", done).otherwise(F.array_append(done, x)),
    )
    flat = F.concat(root_url(c), F.regexp_replace(F.array_join(steps, "/"), "^/+", ""), F.regexp_extract(c, _PARTS, 4))
    return F.when(path(c).rlike(r"(^|/)\.\.?(/|$)"), flat).otherwise(c)


def relevant_link(anchor: Column, url: Column, keywords: Iterable[str] = KEYWORDS) -> Column:
    """Whether a link's words or address hold a keyword and don't put it out of scope."""
    seen = norm_search(F.concat_ws(" ", anchor, url))
    scope = F.translate(seen, "-", "_")
    off = (scope.contains("desenvolvimento_social") | has_any(scope, OFF_TOPIC)) & ~has_any(scope, RELEVANT)
    return has_any(seen, [norm_python(k) for k in keywords]) & ~off


def unit_page(c: Column) -> Column:
    """A page about one department."""
    return F.concat(F.regexp_replace(F.lower(path(c)), "/+$", ""), F.lit("/")).rlike("/(secretaria|secretarias|secretarias-especiais)/")


def contact_page(c: Column) -> Column:
    return F.regexp_replace(F.lower(path(c)), "/+$", "").rlike("/(contatos?|fale[-_]conosco)(/|$)")


def path_names_role(role: Column, c: Column) -> Column:
    """Whether a page's path is about the role itself."""
    p, wanted = F.translate(norm_search(path(c)), "-", " "), F.translate(norm_search(role), "-", " ")
    return F.when(role == "Prefeito", p.contains("prefeito") & ~p.contains("vice prefeito")).otherwise((wanted != "") & p.contains(wanted))


def reference_url(site: Column, source: str) -> Column:
    """The site, or the source of the target list where there is none."""
    return F.when(blank(site), F.lit(source)).otherwise(site)


def live(code: Column, content_type: Column, timed_out: Column, lenient: bool = False) -> Column:
    """Whether a recorded answer shows a site that is up; leniently, one that turns robots away or lets them wait counts too."""
    page = (code < 400) & (blank(content_type) | F.lower(content_type).contains("html"))
    away = code.isin(TURNED_AWAY) | F.coalesce(timed_out, F.lit(False)) if lenient else F.lit(False)
    return F.coalesce(page | away, F.lit(False))


def capped_text(body: Column, most: int = MOST_BYTES) -> Column:
    """The text of a page's bytes, of at most ``most`` of them; bytes that are no UTF-8 are replaced."""
    return F.call_function("make_valid_utf8", F.substring(body, 1, most).cast("string"))


def block_page(text: Column, html: Column) -> Column:
    """Whether a page says that access is denied; a captcha on a page of substance doesn't count."""
    seen = norm_search(F.concat_ws(" ", text, F.substring(html, 1, 3000)))
    body = norm_search(text)
    strong = has_any(seen, ["access denied", "acesso negado", "forbidden", "verify you are human", "verifique se voce e humano", "cloudflare error", "attention required", "temporarily blocked"])
    weak = has_any(seen, ["captcha", "recaptcha", "cloudflare"])
    useful = (F.length(body) >= 350) & has_any(body, ["prefeitura", "secretaria", "gabinete", "prefeito", "contato", "equipe de governo"])
    return F.coalesce(strong | (weak & ~useful), F.lit(False))


def fetch_status(code: Column, content_type: Column, error: Column) -> Column:
    """The state of a recorded fetch."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return (
        F.when(error.isNotNull(), "Site fora do ar")
        .when(code.isin(401, 403, 429), "Bloqueio técnico")
        .when(code >= 500, "Site fora do ar")
        .when(code >= 400, "Página sem informação pública")
        .when((kind != "") & ~kind.rlike("html|text"), "Página sem informação pública")
        .otherwise("Encontrado")
    )
