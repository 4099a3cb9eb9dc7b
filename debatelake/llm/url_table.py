"""A small labelled table of URLs, the default training data of the URL filter.

Fixed values: invented addresses, one a line, by what their sites offer.
"""

BLOCK = """
http://www.royal-casino-games.com/en/3
http://casino.goldenreels.net/de/11
https://luckyjackpot-casino.org/es/100
http://onlinecasino-club.info/slots.html
https://poker-stars-free.com/download
http://m.pokerroom247.net/fr/2.html
http://best-betting-odds.com/en/45
https://sportsbets-live.net/today?ref=9
http://bet365-bonus.org/signup
http://freebets-daily.co/offers
https://www.free-spins-now.com/en/
http://bigwin-lottery.net/winner
https://winner-lotto.info/claim/77
http://jackpot-winners.org/prize
http://cheapviagra-store.com/de/6
https://buy-cheap-meds.net/pills
http://pills-online-pharmacy.org/es/9
https://www.discount-pharma-rx.com/cialis
http://rx-pills.biz/no-prescription
http://diet-pills-miracle.com/fat
http://cheap-replica-watches.net/rolex
https://replica-bags-outlet.com/sale
http://cheapjerseys-outlet.org/nfl
http://www.cheap-handbags-shop.net/fr/31
https://payday-loans-fast.com/apply
http://instant-cash-loan.net/approve
http://badcredit-loans.org/quick
https://cash-advance-now.info/loan
http://xxx-videos-free.com/watch
http://hot-porn-tube.net/en/5
https://adult-cams-live.com/de/8?page=2
http://www.adultfriend-dating.net/meet
http://sexcam-chat.org/room/3
https://xxxadult.biz/es/1
http://adultvideo-x.com/new
http://sexy-singles-dating.info/tonight
https://hookup-dating-adult.com/
https://casino-royale-club.org/de/2
http://m.casino777.org/en/8
http://the-best-casino.info/fr/5
https://blog.win-at-casino.net/es/3
http://free-poker-casino.org/
http://escort-girls-city.net/list
http://adserver.clicktracker.net/banner?id=4
https://ads.popup-network.com/en/70
http://track.adclick-media.net/go/88
https://tracker-ads.com/fr/14.html
http://banner-ads-exchange.org/show
http://click-track-link.com/r?u=1
https://popunder-ads.net/js
http://traffic-tracking-ads.info/t/2
http://spam-mailer.com/en/2
https://spamlinks-farm.net/de/7
http://linkfarm-directory.org/add
http://seo-link-farm.com/buy-backlinks
https://article-spam-network.info/post
http://free-warez-download.com/es/19
https://keygen-crack-serial.net/full
http://cracked-software-free.org/get
http://warezportal.biz/torrent
https://free-serial-keys.com/keygen
http://malware-cleaner-alert.com/en/4
https://your-pc-infected-alert.net/fix
http://account-verify-login.com/secure
https://paypal-login-verify.net/update
http://phishing-bank-login.org/confirm
http://free-iphone-winner.com/claim
https://freegift-cards-now.net/fr/6
http://earn-money-fast-home.com/join
https://make-cash-online.biz/start
http://bitcoin-doubler-free.net/invest
https://crypto-profit-robot.com/signup
http://miracle-weightloss-pills.com/buy
http://hair-growth-cheap.net/order
http://work-from-home-cash.info/apply
"""

ALLOW = """
https://www.city-library.org/catalog/12
http://library.northhill.edu/en/10
https://www.river-museum.org/visit
http://museum-of-science.net/exhibits/5
https://news.daily-herald.com/en/21.html
http://www.morningpost.net/world/article12.html
https://evening-gazette.org/local
http://radio-north.com/de/18/
https://www.weather-service.org/forecast/en/14
http://weathermap.net/today
https://www.lakeside-school.edu/de/32?page=2
http://greenfield-school.org/news/2020
https://university-of-mountains.edu/physics
http://www.state-university.edu/fr/94
https://chemistry.oldtown.edu/lab
http://astronomy-club.org/stars
https://gardening-notes.com/fr/81.html
http://www.garden-seeds.net/spring
https://kitchen-recipes.com/bread/3
http://homebaking.org/de/5
https://www.soupandstew.net/recipe/45.html
http://village-bakery.com/opening-hours
https://mountain-hiking.org/fr/9.html
http://www.alpine-travel.com/huts
https://train-timetable.net/station/8
http://citybus.org/es/36/
https://www.harbour-ferry.com/schedule
http://airport-info.net/arrivals
https://health-advice.org/es/86?page=2
http://www.county-hospital.org/clinics
https://doctors-journal.com/issue/12
http://nursing-college.edu/en/220
https://parliament-watch.org/debates/77
http://www.government-archive.net/records
https://local-council.org/en/171.html
http://courtreports.com/case/1998
https://history-society.org/maps
http://www.medieval-studies.net/de/48/
https://old-photographs.com/fr/6
http://family-trees.org/names
https://open-source-forum.com/de/122?page=2
http://www.linux-users.org/wiki
https://programming-notes.net/python
http://compiler-design.org/fr/304
https://database-weekly.com/issue/20
http://developer-handbook.org/en/chapter2
https://mathematics-lessons.com/fr/231.html
https://physics-lectures.net/optics
http://biology-online.org/en/3
https://earthquakes.org/es/60/
http://www.ocean-research.net/data
https://bird-watchers.org/es/41
http://forest-service.net/es/158?page=2
https://farm-and-field.com/harvest
http://horse-riding-club.org/lessons
https://www.football-club-north.com/en/388
http://tennis-results.net/en/2018
https://chess-players.org/games/3
http://marathon-running.com/en/291.html
https://swimming-pool.org/times
http://www.concert-hall.net/programme
https://choir-and-organ.org/de/72/
http://guitar-lessons.com/chords
https://film-reviews.net/1957
http://theatre-tickets.org/de/194?page=2
https://poetry-pages.com/en/88.html
http://www.novel-readers.org/club
https://translators-desk.net/fr/472
https://language-exchange.net/de/lesson
http://www.dictionary-online.org/fr/mot
https://maps-and-places.com/es/ciudad
http://tourist-office.org/it/arrivo
https://hotel-by-the-sea.com/rooms
http://campingplatz.net/fr/366.html
https://www.stadtwerke.org/strom
http://rathaus-info.net/de/termine
https://schule-am-wald.org/es/87/
http://buchhandlung.com/neu
https://www.mairie-info.org/fr/services
http://ecole-du-lac.net/es/239?page=2
https://boulangerie-martin.com/pains
http://bibliotheque.org/livres/5
https://ayuntamiento.net/es/noticias
http://www.biblioteca-central.org/libros
https://colegio-del-rio.com/alumnos
http://panaderia.net/en/598
https://personal-blog.net/about
http://blog.anna-writes.com/2021/05
https://my-old-cat.org/en/441.html
http://notes.smallthoughts.net/essay
https://weekend-projects.com/shed
http://carpentry.org/de/102/
https://electric-repair.net/radio
http://bicycle-workshop.com/brakes
https://used-books-shop.org/de/284?page=2
http://www.paper-and-ink.com/pens
https://furniture-makers.net/de/77
https://insurance-advice.org/fr/682
http://www.savings-bank.com/branches
https://tax-office.net/forms/3
http://statistics-bureau.org/fr/501.html
https://job-centre.org/vacancies
http://charity-shop.net/donate
https://animal-shelter.org/es/114/
http://fire-brigade.net/history
https://water-company.com/quality
http://energy-agency.org/es/320?page=2
https://encyclopedia-pages.org/wiki/Rain
http://questions-answers.net/q/889
https://standards-institute.org/en/766
http://conference-papers.net/2016/12
https://journal-of-ideas.org/vol3
http://www.science-today.com/en/561.html
"""
