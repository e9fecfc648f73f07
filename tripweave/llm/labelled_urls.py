"""A small labelled URL table of invented addresses, ten kinds of unwanted and ten of wanted sites (fixed values).

The labels are those of the kind of site. Hosts end alike in both halves, so that only names and paths tell.
"""

from __future__ import annotations

import random

UNWANTED = {
    "gambling": [
        "casino-royal-spins/bonus", "lucky-slots-jackpot/play-now", "bet365win/sports-betting", "online-poker-bets/free-chips",
        "roulette-casino/en/welcome-bonus", "free-spins-casino/de/slots", "betting-tips-today/odds", "win-big-lottery/claim",
        "sportsbet-odds/live", "blackjack-win/casino/table",
    ],
    "pharmacy": [
        "cheap-viagra-pills/order", "buy-cialis-online/no-prescription", "pharmacy-discount-meds/pills", "diet-pills-cheap/weight-loss",
        "generic-pills-store/buy-now", "steroids-shop/cheap", "no-prescription-rx/fr/tramadol", "weight-loss-miracle/pills",
        "xanax-cheap/es/order", "painkillers-buy/pills",
    ],
    "adult": [
        "xxx-adult-tube/videos", "hot-sex-cams/live", "adult-dating-x/meet", "porn-videos-free/watch", "nude-teens-cams/en/1",
        "escort-girls-city/de/2", "sexy-adult-chat/free", "xxx-movies/porn", "adult-toys-sex/shop", "milf-x-videos/hd",
    ],
    "advertising": [
        "adserver-track/click", "ad-banner-network/pixel.gif", "popup-ads-click/redirect", "tracking-pixel-ads/t.js", "ads-delivery/serve",
        "click-track-ad/aff", "affiliate-ads-tracker/offer", "doubleads-syndicate/banner", "track-clicks/redirect", "adtrack-server/impression",
    ],
    "link farms": [
        "seo-link-farm/backlinks", "spam-backlinks/buy", "linkfarm-directory/free-links", "article-spinner-spam/1", "guest-post-spam/links",
        "cheap-backlinks/seo-farm", "link-exchange-spam/farm", "doorway-pages-seo/2", "spamdirectory-farm/submit", "content-farm-clicks/3",
    ],
    "loans": [
        "payday-loans-fast/apply", "quick-cash-loans/no-credit-check", "instant-loan-approval/cash", "bad-credit-loan/now",
        "forex-profit-signals/win", "binary-options-win/get-rich", "crypto-doubler/invest", "make-money-fast/work-from-home",
        "free-money-cash/claim", "debt-relief-cheap/fast",
    ],
    "fraud": [
        "secure-login-verify-account/confirm", "account-update-paypa1/login", "free-gift-card/winner", "you-won-iphone/claim-prize",
        "bank-verify-login/update", "apple-id-locked/verify", "prize-winner-claim/survey", "free-survey-gift/win",
        "password-reset-verify/login", "tax-refund-claim/verify",
    ],
    "pirated goods": [
        "crack-keygen-serial/download", "warez-torrent-free/full-version", "free-movie-stream-hd/watch", "nulled-scripts-crack/rar",
        "torrent-download-crack/keygen", "mod-apk-hack/free", "cracked-games-free/download", "serial-keys/crack", "hack-cheats-free/generator",
        "free-mp3-download/torrent",
    ],
    "fakes": [
        "replica-watches-cheap/rolex", "fake-designer-bags/replica", "cheap-jerseys-wholesale/outlet", "replica-handbags/discount",
        "cheap-ray-ban-outlet/sale", "cheap-nike-wholesale/outlet", "fake-id-cards/buy", "buy-followers-cheap/likes",
        "buy-likes-instant/followers", "cheap-essay-writing/buy-essay",
    ],
    "bait": [
        "shocking-celebs-gossip/you-wont-believe", "viral-clickbait/10-tricks", "doctors-hate-this/trick", "secret-trick-rich/win",
        "miracle-cure-exposed/free-trial", "hot-singles-near/free", "clickbait-viral-win/quiz", "free-stuff-samples/win",
        "win-free-prizes/spin", "cheap-tricks-exposed/shocking",
    ],
}
WANTED = {
    "news": [
        "morning-herald/politics/budget", "daily-chronicle/world/election", "evening-post/en/city-council", "national-gazette/economy/trade",
        "regional-observer/de/stadtrat", "harbour-times/local/bridge", "press-review/fr/culture", "tribune-online/opinion/editorial",
        "weekly-courier/es/economia", "northern-echo-archive/2014/storm",
    ],
    "science": [
        "physics-letters/articles/42", "journal-of-ecology/issue/7", "astronomy-society/papers", "marine-biology-institute/research",
        "geology-survey/reports/7", "chemistry-review/abstract", "climate-data/stations/12", "mathematics-archive/preprints",
        "genetics-laboratory/publications", "botanical-science/herbarium",
    ],
    "education": [
        "state-university/courses/history", "open-lectures/linear-algebra", "primary-school/teachers", "language-course/de/grammatik",
        "college-library/catalogue", "student-handbook/enrolment", "learning-centre/reading", "academy-of-arts/curriculum",
        "distance-education/modules", "music-school/lessons",
    ],
    "libraries": [
        "public-library/opening-hours", "national-archive/collections", "digital-manuscripts/folio/3", "city-museum/exhibitions",
        "heritage-foundation/buildings", "folklore-collection/songs", "rare-books/author/dickens", "photography-archive/1920",
        "history-society/essays", "maritime-museum/ships",
    ],
    "government": [
        "ministry-of-health/guidelines", "city-hall/permits", "parliament-records/debates", "statistics-office/population",
        "transport-authority/timetables", "weather-service/forecast", "land-registry/forms", "water-authority/quality",
        "fire-department/safety", "census-bureau/tables",
    ],
    "software": [
        "developer-documentation/api/reference", "open-source-project/issues/88", "compiler-manual/options", "database-handbook/indexes",
        "programming-forum/threads/91", "kernel-notes/release", "web-standards/specification", "package-index/version/2.1",
        "network-guide/routing", "type-theory-notes/lambda",
    ],
    "home": [
        "garden-diary/tomatoes", "home-cooking/recipes/bread", "woodworking-notes/bench", "knitting-patterns/scarf", "bird-watching/herons",
        "bicycle-repair/brakes", "family-travel/alps", "mountain-hiking/routes", "photo-journal/winter", "kitchen-stories/fr/soupe",
    ],
    "health": [
        "childrens-hospital/departments", "nursing-association/standards", "patient-information/asthma", "dental-practice/appointments",
        "nutrition-research/vitamins", "medical-dictionary/terms", "physiotherapy-centre/back", "mental-health-support/help",
        "public-health-institute/vaccines", "midwives-association/advice",
    ],
    "clubs": [
        "football-club/fixtures", "chess-federation/rankings", "rowing-association/regatta", "theatre-group/tickets", "orchestra/concerts",
        "athletics-club/results", "sailing-school/calendar", "choir-rehearsals/programme", "tennis-league/standings", "scouts-association/camps",
    ],
    "trade": [
        "railway-company/stations", "furniture-maker/tables", "architects-office/projects", "printing-house/paper", "electric-supplies/cables",
        "farmers-cooperative/produce", "insurance-broker/contact", "hotel-by-the-lake/rooms", "bakery-and-cafe/menu", "publishing-house/authors",
    ],
}
# Parts of syllables of which names without a meaning are made.
_ONSETS = "b c d f g h j k l m n p r s t v w th sh ch st tr".split()
_VOWELS = "a e i o u ea ou".split()
_CODAS = "n r s t l d nd st ng nt".split()
_PREFIXES = ("", "www.", "m.", "blog.")
_ENDS = ("example.com", "example.org", "example.net")


def meaningless_names(n: int, seed: int = 7) -> list[str]:
    """Names of two or three random syllables."""
    draw = random.Random(seed)
    return ["".join(draw.choice(_ONSETS) + draw.choice(_VOWELS) + draw.choice(["", *_CODAS]) for _ in range(draw.choice((2, 2, 3))))
            for _ in range(n)]


def _page(i: int) -> str:
    """A path that tells nothing."""
    return f"{('en', 'de', 'fr', 'es')[i % 4]}/{i}{('', '.html')[i % 2]}"


def labelled_urls() -> list[tuple[str, int]]:
    """``url, label`` (1: unwanted): each site with its own path and with one that tells nothing, under prefixes
    and ends that are dealt alike to both labels.

    As many sites again have names without a meaning and are wanted: a name of unknown letters is no reason to block.
    """
    rows = []
    for label, kinds in ((1, UNWANTED), (0, WANTED)):
        for i, site in enumerate(site for sites in kinds.values() for site in sites):
            host, path = site.split("/", 1)
            for k, shown in enumerate((path, _page(i))):
                rows.append((f"https://{_PREFIXES[(i + k) % 4]}{host}.{_ENDS[(i + k) % 3]}/{shown}", label))
    for i, name in enumerate(meaningless_names(len(rows) // 2)):
        rows.append((f"http://{_PREFIXES[i % 4]}{name}.{_ENDS[i % 3]}/{_page(i)}", 0))
    return rows
