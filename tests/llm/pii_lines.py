"""Lines written by hand, kept apart from what the network is trained on: personal data stands between « and »."""

MARKED = """
My SSN is «123-45-6789», please keep it safe.
Ring me on «415 555 2671» after six.
Her number, «(212) 867-5309», has not changed since 1998.
Call «020 7946 0958» and ask for Mr Hughes.
Mobile: «07700 900123»
Office 1-«800-555-0142» ext 7
Tel. «030/23125123» (mornings only)
Appelez le «01 42 68 53 00» avant 18h30.
Llámame al «912 345 678» o ven el 12/05.
Reach Dana at «617.555.0188».
Transfer the deposit to «GB29 NWBK 6016 1331 9268 19» by Friday.
IBAN: «DE89 3704 0044 0532 0130 00»
Bitte auf «DE44500105175407324931» überweisen.
Compte «FR14 2004 1010 0505 0001 3M02 606», merci.
He paid with «4539.1488.0343.6467» last week.
The printer sits at «00:1A:2B:3C:4D:5E» on the second floor.
Device «3c-22-fb-9a-01-7e» joined the network.
Server address «2001:0db8:85a3:0000:0000:8a2e:0370:7334» answered in 12 ms.
We saw traffic from «fe80:0:0:0:0202:b3ff:fe1e:8329» all night
Write to «jane.doe (at) example (dot) org» for tickets.
Contact: «peter.maier[at]firma.de»
«info (At) museum.fr» takes bookings.
Mail «l.garcia ( at ) correo.es» about the flat
Passport no. «C01234567» was issued in Lyon.
Travel document «XK4471823» is missing.
Social security number: «078-05-1120»
SSN «219 09 9999» belongs to a wallet maker
The nurse left her number (it's «503-555-0170») on the desk.
«646.555.0131» is the fax.
Dial «0161 496 0345» for the Manchester desk.
Madrid office: «934 112 233».
Pay «NL91ABNA0417164300» today
"""

HARMLESS = """
The meeting of 2021-03-04 was moved.
At 12:30:55 the lights went out.
Born under a bad sign, he said on 5 May 1961.
Version 10.4.22 fixes the crash.
It costs 1,299.00 EUR with tax.
The final score was 3-2 after 120 minutes.
See chapter 12, pages 340-355.
ISBN 978-3-16-148410-0
Room 404 is on floor 4.
Turn to John 3:16 or Psalm 23:1-6.
The years 1914-1918 changed Europe.
Flight BA 2490 leaves from gate B32.
He ran 100 m in 9.58 seconds.
Add 3 + 4 = 7 and carry on.
Screen ratio 16:9, or 4:3 on old sets.
Paris lies at 48.8566, 2.3522 on the map.
Order #88213 shipped on 03.11.2019.
About 7,900,000,000 people live on Earth.
Standard ISO 8601:2019 tells how.
The file has 20480 bytes and 512 lines.
Between 10 and 20 % of 1,500 voters stayed home.
Colour #ff8800 looks best on #202020.
Bus 42 runs every 15 minutes until 23:45.
In 1 234 567 cases out of 2 000 000 it held.
Serial XC-90 and RS-232 are model names.
Article 12.4(b) of the act of 1998 applies.
Mix 250 g flour, 2 eggs and 1/2 l milk.
commit 9fceb02d0ae598e95dc970b74767f19372d61af8
Meet me (at noon) in hall 7.
Population: 83,155,031 (2020), 357,386 km2.
"""


def lines() -> list[tuple[str, list[tuple[int, int]]]]:
    """Each line as a text and its spans."""
    out = []
    for line in [*MARKED.strip().split("\n"), *HARMLESS.strip().split("\n")]:
        text, spans = "", []
        for k, part in enumerate(line.replace("»", "«").split("«")):
            if k % 2:
                spans.append((len(text), len(text) + len(part)))
            text += part
        out.append((text, spans))
    return out
