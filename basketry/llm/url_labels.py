"""A small labelled table of URLs: invented hosts and paths, 1 is to be blocked."""

from __future__ import annotations

#: Casinos and bets, pills, advertising and tracking, adult pages, loans, fakes, link farms.
BLOCK = """
http://casino-lucky.example.com/play/bonus
https://www.royal-casino.example.net/en/slots
http://m.win-casino.test/free-spins.html
https://bigwin-casino.example.org/en/311
https://online-casino-bonus.test/de/roulette
http://blog.casino777.test/jackpot
https://poker-win.example.com/fr/2201
http://jackpot-slots.test/en/55
https://free-spins.test/win-now
http://lotto-winner.example.net/claim.php
https://sport-bets.example.com/odds
http://www.bets-online.test/en/8812
https://freebet-club.test/free-bets/today
http://m.live-bets.example.net/en/77.html
https://best-bets.test/fr/901
http://free-bonus.example.com/de/12/
https://cheap-meds.example.com/order
http://www.pills-online.test/en/buy
https://buy-pills.example.net/viagra-cheap
http://m.cheap-viagra.test/en/10
https://discount-pills.example.org/cialis.html
http://diet-pills.test/lose-weight-fast
https://cheap-cialis.test/de/44
http://pharma-cheap.test/no-prescription/
https://ads-server.example.com/click
http://www.ad-track.test/pixel.gif
https://track-click.example.net/redirect
http://ads.banner-track.test/en/5
https://clicktrack.test/adserver/imp
http://m.popunder-ads.example.com/go
https://adclick-tracker.test/track/8
http://ads-network.example.org/serve
https://hot-xxx-cams.test/live
http://www.adult-cams.example.com/en/9
https://free-porn-tube.test/videos
http://sexy-dates.test/join
https://xxx-movies.example.net/de/71
http://escort-girls.test/en/city
https://payday-loans.example.com/apply-now
http://fast-cash-loans.test/en/6
https://easy-credit-now.test/no-check
http://quick-loans.example.net/en/120.html
https://bitcoin-doubler.test/invest
http://crypto-profit.example.com/get-rich
https://earn-money-fast.test/work-home
http://replica-watches.example.com/rolex
https://cheap-replica-bags.test/en/4
http://fake-id-shop.test/order
https://cheap-handbags.example.net/sale/fr/3
http://free-iphone-winner.test/claim-prize
https://you-won-prize.test/survey
http://free-gift-cards.example.com/generator
https://warez-crack.test/keygen
http://cracked-games.example.net/download/serial
https://torrent-warez.test/en/713
http://buy-backlinks.example.com/seo-links
https://seo-link-farm.test/directory/9
http://buy-followers.test/cheap-likes
https://spam-mailer.example.org/bulk
http://essay-cheap.test/buy-essay
https://blog.lucky-casino.example.net/en/4471
http://blog.casino-tips.example.org/fr/812?page=2
https://blog.winbig-casino.example.com/de/6210/
http://m.casino-spin.example.net/es/501
https://blog.pills-cheap.example.net/en/9120.html
http://blog.cheap-tablets.example.net/es/77
https://m.pills4you.example.org/fr/3301
http://www.sleeping-pills.example.com/de/5120
https://blog.ads-media.example.com/en/1022
http://m.ads-tracker.example.com/de/6623/
https://m.ad-tracking.example.com/fr/7102
http://m.trackads.example.net/en/4410.html
https://www.adstrack-pixel.example.org/es/98
https://blog.free-betting.example.net/en/3011
http://m.freebets-daily.example.com/fr/5514
https://www.bets-free.example.net/de/2210#top
http://free-betclub.example.net/en/6001
http://tracking-ads.example.com/en/873
""".split()

#: Ordinary pages: news, schools, towns, clubs, manuals, shops, personal pages.
ALLOW = """
https://www.morning-herald.example.com/news/4410
http://city-library.example.org/en/catalogue/12
https://blog.thegardener.example.net/en/8812
http://tionlen.example.com/en/5102
https://m.therold.example.net/fr/3310?page=2
http://www.thington.example.org/de/901.html
https://thesanre.example.net/es/4471/
http://blog.ththor.example.net/en/12
https://therealm.example.com/en/7201.html
http://m.shethth.example.com/es/66
https://ththoun.example.net/en/2033
http://thentio.example.org/fr/500/
https://www.erthing.example.com/en/918
http://university.example.org/physics/lectures
https://docs.pythonlib.example.net/en/latest/tutorial
http://weather.northport.example.com/today
https://en.encyclopedia.example.org/wiki/Glacier
http://www.townhall.example.net/council/minutes/2019
https://recipes.homecook.example.com/soup/tomato
http://travelnotes.example.net/norway/fjords.html
https://history-society.example.org/archive/1848
http://m.sportsclub.example.com/football/results
https://science-today.example.net/articles/7731
http://www.musicschool.example.org/piano/lessons
https://blog.carpenter.example.com/oak-table
http://museum.example.org/en/exhibitions/8
https://railway-times.example.net/timetable
http://forum.cyclists.example.com/thread/66120
https://www.birdwatch.example.org/species/heron
http://localnews.example.net/de/4502
https://magazine.example.com/fr/culture/2203
http://observatory.example.org/images/saturn
https://open-maps.example.net/tiles/help
http://www.hillside-school.example.org/parents
https://kernel-notes.example.com/scheduler/design
http://m.bookreview.example.net/es/novelas/31
https://theatre.example.org/en/programme.html
http://blog.bakery.example.com/bread/rye
https://statistics.example.net/tables/population
http://www.chessclub.example.org/games/1972
https://legal-texts.example.com/en/statutes/14
http://hospital.example.org/visitors
https://blog.marine-life.example.net/en/whales
http://languagelab.example.com/es/verbos
https://astro.example.org/en/1021/
http://www.railmuseum.example.net/fr/histoire
https://festival.example.com/2018/line-up
http://m.cityguide.example.org/de/parks
https://architects.example.net/projects/bridge
http://the-daily-record.example.com/en/9921
https://www.oceaninstitute.example.org/reports/2020
http://philosophy.example.net/essays/stoics
https://mathworld.example.com/en/primes
http://blog.translation.example.org/en/300.html
https://village.example.net/news/harvest
http://www.engine-manual.example.com/parts/valves
https://radio.example.org/programmes/evening
http://m.nature.example.net/en/7710
https://poetry.example.com/fr/sonnets
http://school-of-design.example.org/courses
https://computing.example.net/archive/lisp
http://www.thwethen.example.com/en/3308
https://tionere.example.org/en/77
http://m.anthere.example.net/de/640
https://blog.seththe.example.com/es/19/
http://inthand.example.net/en/4801#top
https://www.resthe.example.org/en/222.html
http://oftheed.example.com/fr/6109
https://m.ertionth.example.net/en/5518
http://handthe.example.org/es/901
""".split()
