"""The words that extraction goes by, and what is compiled from them once a worker."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from gazetta.functions.extract import ROLES
from gazetta.functions.patterns import Automaton, Mentions, stems
from gazetta.functions.text import ACCENTED, PLAIN, norm_python

GENERAL, EXECUTIVE = "Contato geral", ("Prefeito", "Vice-prefeito", "Chefe de gabinete")
# Defaults: words that no person's name holds. Lists tuned to a country's sites run to
# hundreds; they are rows of a table of rules (``operators.rules``), in place of these.
NOT_NAMES = {
    "acessar", "acesso", "administracao", "agenda", "agricultura", "andar", "assessor", "assessoria", "assistencia", "atendimento", "avenida", "bairro", "biografia", "camara", "casa", "centro",
    "chefe", "chefia", "cidadania", "cidade", "comercio", "concursos", "conselho", "contato", "contatos", "controladoria", "coordenacao", "cultura", "dados", "defesa", "departamento", "deputada",
    "deputado", "diario", "diretor", "diretoria", "divisao", "economico", "educacao", "email", "endereco", "equipe", "escola", "esporte", "estado", "estadual", "estrutura", "eventos", "executivo",
    "fale", "federal", "financas", "foto", "fotos", "gabinete", "galeria", "geral", "gestao", "governo", "habitacao", "horario", "imagem", "imprensa", "infraestrutura", "inicio", "juridico", "lei",
    "leis", "legislacao", "licitacao", "licitacoes", "mais", "menu", "mulher", "municipal", "municipais", "municipio", "noticia", "noticias", "obras", "oficial", "orgao", "ouvidoria", "planejamento",
    "poder", "politica", "portal", "praca", "prefeita", "prefeito", "prefeitura", "presidente", "procurador", "procuradoria", "programa", "projetos", "publica", "publico", "recursos", "redes",
    "responsavel", "rua", "saude", "secretaria", "secretarias", "secretario", "seguranca", "servico", "servicos", "sistema", "site", "sobre", "social", "sociais", "tecnologia", "telefone",
    "telefones", "trabalho", "transparencia", "turismo", "unidade", "urbano", "veja", "ver", "vereador", "vereadores",
}
NOT_NAME_PHRASES = ["minas gerais", "mato grosso", "rio branco", "sao paulo", "casa civil", "meio ambiente", "poder executivo", "quem somos", "clique aqui", "continue lendo", "obras publicas"]
NOT_NAME_STARTS = ["casado", "cirurgiao", "foi", "servidor", "vereadora", "vereador", "prefeitos", "introducao", "adjunto"]
# Words that are no part of a name at its beginning and at its end.
EDGE_FIRST = {
    "assessor", "assessora", "chefe", "completo", "curriculo", "deputada", "deputado", "destaque", "destaques", "detalhes", "fechar", "habitacao", "historia", "horario", "horarios", "imprimir",
    "introducao", "nome", "pelo", "principal", "responsavel", "responsaveis", "titular",
}
EDGE_LAST = {
    "acao", "acoes", "ao", "biografia", "dados", "data", "detalhes", "adjunta", "adjunto", "em", "endere", "fone", "formulario", "funcao", "categoria", "corrigir", "dr", "dra", "conheca", "graduada",
    "graduado", "introducao", "na", "partido", "procurador", "procuradora", "saber", "sede", "vice",
}
# Lines that end a profile, that credit a picture, that give an address, and that go on with contacts; words of kinship.
DATA_SECTIONS = ("endereco", "localizacao", "horario", "humanos", "data", "horario de funcionamento", "informacoes", "links uteis")
SUBUNITS = ("assessoria", "coordenacao", "coordenadoria", "conselho", "cras", "creas", "departamento", "diretoria", "diretor", "divisao", "gerencia", "programa", "setor", "superintendencia", "unidade")
CREDITS = ("foto", "fotos", "credito", "creditos", "imagem", "imagens", "autor", "autoria", "reportagem", "redacao")
ADDRESSES = ("alameda ", "avenida ", "av ", "av. ", "bairro ", "cep", "endere", "endereco", "estrada ", "localiza", "localizacao", "logradouro", "praca ", "rodovia ", "rua ", "travessa ")
ADDRESS_WORDS = ("endere", "localiza", "logradouro", "rua", "avenida", "av.", "av ", "praca", "rodovia", "travessa")
CONTACT_LINES = ("contatos", "contato", "e-mail", "email", "telefone", "telefones", "fone", "celular", "whatsapp")
FAMILY = ("esposa", "esposo", "companheira", "companheiro", "filho", "filha", "mae", "pai", "irmao", "irma")
UNIT_TITLES = ("secretaria municipal ", "secretaria de ", "secretaria da ", "secretaria do ", "controladoria ", "procuradoria ", "hospital municipal", "recursos humanos", "caixa de previdencia")
PROFILE_STARTS = (
    "secretaria de ", "secretaria da ", "secretaria do ", "secretaria municipal", "secretaria estadual", "departamento de ", "diretoria de ", "superintendencia de ", "chefia de ", "fundacao ",
)
AGENCY_NAMES = ("agencia de desenvolvimento", "sala do empreendedor", "casa do empreendedor", "banco do povo")
GENERIC_BOXES = ("administra@", "contato@", "ouvidoria@", "comunicacao@", "administracao@")

_DEVELOPMENT = ("banco-do-povo", "casa-do-empreendedor", "desenvolvimento", "empreendedor")
_OF_EXECUTIVE = ("prefeito", "vice", "gabinete", "equipe", "gestores")
_OF_ECONOMY = ("desenvolvimento", "industria", "comercio", "empreendedor", "trabalho")
_NAMED_ECONOMY, _AGENCY = "Secretaria de Desenvolvimento Econômico", "Agência/Sala de Desenvolvimento"


@dataclass(frozen=True)
class Against:
    """A source speaks against the roles where its path or address holds one of the words and its path none of the others."""

    roles: tuple[str, ...]
    path: tuple[str, ...] = ()
    url: tuple[str, ...] = ()
    unless: tuple[str, ...] = ()


#: Fixed values, a row a rule; no role named: every role but the general contact. Roles are those of the extraction and the categories made from them.
AGAINST = [
    Against((), path=("carta-servicos", "cartaservicos", "legislacao", "leis", "sileg"), url=("download?type=txt", ".pdf")),
    Against((), path=("servico",), unless=("carta-de-servico orgao", "desenvolvimento")),
    Against(("Prefeito",), path=("vice",), unless=("prefeito-e-vice", "prefeitoevice")),
    Against(("Prefeito",), path=("chefe-de-gabinete",), url=("especialgabinete", "contas-do-prefeito", "/prefeitos")),
    Against(("Vice-prefeito",), path=("primeira-dama",)),
    Against(EXECUTIVE, path=("fale-com-o-prefeito", "contato", "assessor-de-imprensa", "assessor", "procuradoria"), url=("cmei", "creche", "escola", "educacao", "estagio", "professor")),
    Against(
        EXECUTIVE,
        path=("assistencia", "secretaria", "mobilidade", "pdu", "unidades", "departamento index", "departamento view", "administracao", "recursos-humanos", " rh", "rh "),
        url=("secretaria.php", "secretarias.php"),
        unless=_OF_EXECUTIVE,
    ),
    Against(("Secretaria de Planejamento", "Planejamento"), path=("assistencia", "cultura", "educacao", "esporte", "saude", "sauacute"), unless=("planejamento",)),
    Against((_AGENCY, "Agências municipais de desenvolvimento"), path=("gabinete", "prefeito", "vice", "assistencia", "cultura", "educacao", "esporte", "financas", "saude", "sauacute", "secretaria"), unless=_DEVELOPMENT),
    Against(
        (_NAMED_ECONOMY, "Desenvolvimento econômico"),
        path=("secretariaview", "assistencia", "contabilidade", "cultura", "educacao", "esporte", "financas", "gabinete", "infraestrutura", "mulheres", "obras", "social", "viacao"),
        unless=_OF_ECONOMY,
    ),
    Against(("Secretaria de Finanças/Fazenda", "Finanças/Fazenda"), path=("cultura", "esporte", "educacao")),
]

_FOLD = str.maketrans(ACCENTED, PLAIN)
_TOKEN = re.compile(r"[^\s\-:,/–—]+")


def folded(text: str) -> str:
    """Without accents and in lower case, character for character."""
    low = text.translate(_FOLD).lower()
    return low if len(low) == len(text) else "".join(c.lower()[:1] or c for c in text.translate(_FOLD))


_OFFICES = ("prefeito", "prefeita")
_CHIEF = re.compile("chef(?:e|ia) de gabinete")
#: A chief of staff of anything but the executive is another role.
_OF_OTHERS = re.compile(r"\s+d[aeo]\s+(?!prefeit[oa]\b|executivo\b|municipio\b|municipal\b)")


class Lexicon:
    """Roles with their variants, and the words and phrases that are no names, ready for lines and texts.

    All of them are found in one pass each, whatever their number: mentions of roles by their words, words by hash, phrases by an automaton.
    """

    def __init__(self, config: dict[str, list[str]], words: Iterable[str] = NOT_NAMES, phrases: Iterable[str] = NOT_NAME_PHRASES):
        self.words, self.phrases = frozenset(words), Automaton(phrases)
        self.variants = {role: sorted({norm_python(v) for v in listed}, key=lambda v: (-len(v), v)) for role, listed in config.items()}
        self.mentions = Mentions((v, role) for role, variants in self.variants.items() for v in variants)
        self.starts: dict[str, list[tuple[tuple[str, ...], str]]] = {}
        self.whole: dict[str, str] = {}
        for role, variants in self.variants.items():
            for v in sorted({norm_python(role), *variants}, key=lambda v: (-len(v), v)):
                tokens = tuple(_TOKEN.findall(v))
                if tokens:
                    self.starts.setdefault(tokens[0], []).append((tokens, role))
                self.whole.setdefault(v.replace("-", " "), role)
        self.stems = role_stems(config)
        self.cabinet = next((r for r, vs in self.variants.items() if "gabinete do prefeito" in vs), None)

    def named(self, low: str) -> bool:
        """Whether a folded text may name a role; where not, nothing else needs to look."""
        return any(s in low for s in self.stems)

    def may_name(self, text: str) -> bool:
        """The same of a raw text, before it is folded: what isn't ASCII after its accents are off can't be part of a literal."""
        low = (text if text.isascii() else unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()).lower()
        return any(s in low for s in self.stems)

    def phrases_of_roles(self, low: str) -> Iterator[tuple[int, int, str, bool]]:
        """``(start, end, role, of_others)`` of each phrase of a role in a folded text, by start; at one start the longest first.

        ``of_others``: what follows makes it the office of anyone but the executive ("chefe de gabinete do secretario").
        """
        for start, end, role in self.mentions.find(low):
            said = low[start:end].replace("-", " ")
            if said in _OFFICES and low[max(0, start - 5) : start] in ("vice-", "vice "):
                continue
            yield start, end, role, bool(_CHIEF.fullmatch(said) and _OF_OTHERS.match(low, end))

    def places(self, low: str) -> Iterator[tuple[int, int, str]]:
        """``(start, end, role)`` of each phrase that names the role itself, by start; at one start the longest first."""
        return ((start, end, role) for start, end, role, of_others in self.phrases_of_roles(low) if not of_others)

    def roles(self, low: str) -> list[str]:
        """The roles that a normal form names as whole words, in the order of the configuration."""
        seen = {role for _, _, role in self.places(low)} if self.named(low) else set()
        if _NAMED_ECONOMY in seen and "desenvolvimento economico" in low:
            seen.discard("Secretaria de Desenvolvimento")
        return [role for role in self.variants if role in seen]


def role_pattern(variants: Iterable[str]) -> str:
    """The mentions of one role in a folded text as a pattern, for the JVM: what ``Lexicon.places`` finds, a role at a time."""

    def form(variant: str) -> str:
        words = r"[ -]".join(re.escape(x) for x in variant.split(" "))
        if variant in _OFFICES:
            return rf"(?<!vice-)(?<!vice ){words}"
        return words + rf"(?!{_OF_OTHERS.pattern})" if _CHIEF.fullmatch(variant) else words

    folded_ones = sorted({norm_python(v) for v in variants}, key=lambda v: (-len(v), v))
    return rf"(?<![\w-])(?:{'|'.join(map(form, folded_ones))})(?![\w-])"


def role_stems(config: dict[str, list[str]]) -> list[str]:
    """Literals of which a text that names a role, however, holds one when folded."""
    return stems([*(v for role, listed in config.items() for v in (role, *listed)), "gabinete"])


def frozen(config: dict[str, list[str]] | None) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """A configuration as a key."""
    return tuple((role, tuple(variants)) for role, variants in (config or ROLES).items())


@functools.lru_cache(maxsize=8)
def _compiled(items: tuple[tuple[str, tuple[str, ...]], ...], words: frozenset[str] | None, phrases: tuple[str, ...] | None) -> Lexicon:
    return Lexicon({role: list(variants) for role, variants in items}, NOT_NAMES if words is None else words, NOT_NAME_PHRASES if phrases is None else phrases)


def lexicon(config: dict[str, list[str]] | None = None, words: Iterable[str] | None = None, phrases: Iterable[str] | None = None) -> Lexicon:
    """The lexicon of a configuration, compiled once a worker."""
    return _compiled(frozen(config), None if words is None else frozenset(words), None if phrases is None else tuple(phrases))


def path_scope(url: str) -> str:
    """The path of an address as words, as the rules of ``AGAINST`` read it."""
    path = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "", url or "")
    return norm_python(re.split(r"[?#;]", path)[0]).replace("_", "-").replace("/", " ")


def against(role: str, url: str) -> bool:
    """Whether a source speaks against a role."""
    path, whole = path_scope(url), norm_python(url or "")
    return any(
        (role in rule.roles if rule.roles else role != GENERAL) and (any(t in path for t in rule.path) or any(t in whole for t in rule.url)) and not any(t in path for t in rule.unless)
        for rule in AGAINST
    )


def is_agency(role: str) -> bool:
    low = norm_python(role)
    return "desenvolvimento" in low and ("agencia" in low or "sala" in low)


def is_root_path(url: str) -> bool:
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "", url or "").split("?")[0].split("#")[0].strip("/") in ("", "index.php", "index.html", "home", "portal")


def out_of_place(role: str, url: str, has_contact: bool) -> bool:
    """Whether a record is dropped for its page: one that speaks against the role, or, without a contact, the wrong or the front page."""
    if against(role, url):
        return True
    if is_agency(role) and not has_contact and not any(t in path_scope(url) for t in _DEVELOPMENT):
        return True
    return role != GENERAL and not has_contact and is_root_path(url)
