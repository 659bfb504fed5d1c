"""A small table of labelled URLs that the URL classifier of the queries learns from."""

# Own examples, hosts and paths in the common forms.
BLOCK = """
https://www.online-casino.example/play/
https://casino-bonus.example/en/slots.html
http://best-casino.example/win?ref=ad
https://big-win.example/jackpot/
https://win-cash.example/de/12
https://free-bets.example/en/101
http://sports-bets.example/odds/
https://bet-now.example/fr/live.html
https://poker-free.example/en/table
https://cheap-meds.example/en/88
http://cheap-pills.example/order/
https://pills-online.example/es/9.html
https://buy-pills.example/en/7
https://cheap-watches.example/shop
https://adult-video.example/en/3
http://adult-chat.example/live/
https://xxx-adult.example/de/44.html
https://hot-x.example/en/5
https://spam-mail.example/en/2
http://link-spam.example/fr/6/
https://link-farm.example/en/page.html
https://content-farm.example/es/15
https://ads-server.example/click
http://ads-popup.example/en/1
https://track-ads.example/pixel.html
https://click-track.example/en/77/
https://user-track.example/id
https://free-money.example/en/now
https://free-download-crack.example/de/8
https://malware-setup.example/get.html
"""
ALLOW = """
https://www.daily-news.example/en/101
https://news.example/world/2021/story.html
http://www.city-library.example/catalog/
https://library.example/de/12/
https://www.university.example/research/paper.html
https://blog.gardening.example/en/57
https://blog.thermal-design.example/fr/301.html
https://m.weather.example/en/402/
https://www.cookbook.example/es/recipe
https://recipes.example/en/88.html
http://museum.example/fr/visit/
https://www.history.example/de/1914
https://docs.software.example/en/guide.html
https://docs.example/api/index
https://wiki.example/en/physics
https://www.thesaurus.example/en/word
http://m.train-times.example/de/9/
https://www.hospital.example/en/contact
https://school.example/fr/12
https://www.music-theory.example/en/205.html
https://blog.mountain-hiking.example/es/31
https://astronomy.example/en/stars/
https://www.translation.example/fr/778
http://council.example/en/notice.html
https://theatre.example/de/plan/
https://www.chemistry.example/en/610
https://blog.painting.example/en/4/
https://m.football.example/es/66
https://www.river-data.example/en/900.html
https://garden.example/fr/45/
"""


def labelled_urls() -> list[tuple[str, int]]:
    """(url, block) of the table."""
    return [(u, 1) for u in BLOCK.split()] + [(u, 0) for u in ALLOW.split()]
