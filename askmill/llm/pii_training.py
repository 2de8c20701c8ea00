"""Generated sentences with known personal details, to train the span model of problem 8.

The sentences are of general language (offices, schools, clinics, shops, travel, courts, chats) and were written for this purpose; none of
them stands in the documents that the model is used on (a test checks it). Names are common given and family names of India and other
countries, and random words, alone or in up to five parts, in several scripts. Phone, card and document numbers follow public formats with
random digits; addresses are put together from parts, with or without a word for the street.
"""

from __future__ import annotations

import random
import re

from .pii import Candidate, Text, candidates

_GIVEN = (
    "Aarav Aditi Ajay Akash Amina Amit Ananya Anil Anita Arjun Asha Ashok Bhavna Chitra Deepak Devika Divya Farah Gaurav Geeta Gopal Harpreet Hari Imran Indira Ishaan Jaya Kabir Kamala Karan Kavita Kiran Lakshmi Lata Leela Madhu Mahesh Manoj"
    " Maria Meena Mohan Mohammed Nadia Naveen Neha Nikhil Nisha Omar Padma Pooja Prakash Priya Rahul Rajesh Ramesh Rekha Ritu Rohan Sandeep Sanjay Sarita Shankar Shanti Sita Sunil Sunita Suresh Tara Uma Usha Varun Venkata Vijay Vinod Yusuf Zoya"
    " Alice Benjamin Carlos Chen Daniel Elena Fatima Grace Hannah Ivan James John Julia Kenji Laura Lucas Mary Michael Noah Olga Pedro Peter Rosa Sarah Sofia Thomas Wei"
).split()
_FAMILY = (
    "Acharya Agarwal Ahmed Ali Banerjee Bhat Bose Chatterjee Chauhan Das Desai Deshmukh Dutta Fernandes Ghosh Gill Gupta Hussain Iyer Jadhav Jain Joshi Kamble Kapoor Kaur Khan Krishnan Kulkarni Kumar Mehta Menon Mishra Mukherjee Murthy Naidu Nair"
    " Pandey Patel Patil Pillai Pradhan Rao Rathore Reddy Roy Sahu Saxena Sen Sethi Shah Sharma Shetty Shinde Singh Sinha Subramanian Thakur Tiwari Varma Yadav"
    " Anderson Brown Cohen Garcia Haddad Ivanova Johnson Kim Kowalski Lopez Martin Mueller Nguyen Okafor Petrov Rossi Sato Silva Smith Tanaka Wang Williams Wong O'Brien D'Souza D'Costa"
).split()
_OTHER_SCRIPTS = {
    "hi": ("राजेश सुनीता अनिल मीना विजय कविता रमेश गीता मोहन सीता", "शर्मा वर्मा यादव गुप्ता सिंह मिश्रा पटेल जोशी"),
    "bn": ("সুমন রীতা অমিত মিতা রাহুল শিখা", "দাস ঘোষ রায় সেন মণ্ডল পাল"),
    "ta": ("முருகன் கவிதா செல்வம் மீனா குமார் லதா", "பிள்ளை ராஜன் சுப்ரமணியன் கண்ணன்"),
    "te": ("రమేష్ లక్ష్మి సురేష్ పద్మ వెంకట్", "రెడ్డి రావు నాయుడు శర్మ"),
    "pa": ("ਹਰਪ੍ਰੀਤ ਗੁਰਮੀਤ ਮਨਜੀਤ ਸਿਮਰਨ", "ਸਿੰਘ ਕੌਰ ਗਿੱਲ ਸੰਧੂ"),
}
_PLACES = "Agra Bengaluru Bhopal Chennai Coimbatore Delhi Guntur Guwahati Hubli Indore Jaipur Kanpur Kochi Kolkata Lucknow Madurai Mumbai Mysuru Nagpur Nashik Patna Pune Raipur Ranchi Salem Surat Thane Udaipur Varanasi Vellore London Berlin Toronto Nairobi".split()
_STREETS = "Road Street Lane Marg Gali Nagar Colony Layout Enclave Extension Avenue Vihar Path Chowk Bazaar Society Towers Apartments Residency Cross Main Sector Block Phase Rd St Ave".split()
_BUILDINGS = "Niwas Sadan Bhavan Kutir Villa Heights Residency Apartments Towers Mansion Chambers".split()
_MONTHS = "January February March April May June July August September October November December".split()
#: Words that stand before names and are no part of them.
_ROLES = "Teacher Driver Nurse Clerk Guide Manager Doctor Student Tenant Owner Officer Inspector Engineer Lawyer Judge Minister Cook Guard Editor Author Coach Captain Director Secretary Principal Farmer Trader Broker Agent Brother Sister Uncle Aunt Cousin Neighbour Friend Colleague Witness Applicant Member Candidate".split()
_WHEN = "Yesterday Today Tomorrow Later Then Now Soon Once Here Meanwhile Afterwards Perhaps Only Even Also When If Because While Since After Before".split()
_DIGITS = "zero one two three four five six seven eight nine".split()

#: {name} etc. are segments to find; {place}, {brand}, {org}, {n}, {date}, {sum}, {code}, {serial} are not.
_WITH = (
    "I am {name} and I live with my parents.", "This is {name} speaking from the front office.", "Please ask {name} to sign the register.", "The form was filled in by {name} on {date}.", "{name} joined the team in {place} last spring.", "We met {name} at the bus stop.",
    "Ms {name} teaches physics here.", "Mr. {name} has paid the fees.", "Dr. {name} is on leave until {date}.", "Shri {name} opened the exhibition.", "Smt. {name} received the prize.", "Prof. {name} gave the lecture.", "Mrs {name} lost her umbrella.", "Miss {name} plays the violin.", "Sir, my son {name} is absent due to fever.",
    "A parcel for {name} is waiting at the counter.", "The witness, {name}, told the court a different story.", "Passenger: {name}\nSeat: {n}B\n", "Full name: {name}", "Name - {name}.", "Name : {name} , Age : {n}", "Customer name: {name}; contact: {phone}; document: {id}.", "Father's name: {name}.", "Patient {name}, aged {n}, was admitted on {date}.",
    "{name} wrote that the train was late.", "{name}: can someone open the gate?", "{name}: I will bring the keys tomorrow.", "{name} | {email} | {phone}", "{name} | {phone} | {email}\n", "{name} and {name} share an office.", "Ask {name} or {name} about the keys.", "With best wishes,\n{name}\n", "Sincerely,\n{name}\n{address}\n{phone}\n", "Yours truly,\n{name}\n", "Kind regards,\n{name}\n{email}\n", "Signature\n{name}\n{address}\n",
    "Dear {name},\nyour library card has expired.", "Hello {name}, how are you today?", "cc: {name}, {email}", "To: {name} <{email}>", "Tenant {name}, identity card {id}, now at {address}.", "{name}, {address}, phone {phone}.", "{name}\n{address}\nTel {phone}\n", "Delivered to {name} at {address}.", "Sold to {name}, {address}.", "{name} of {address} is the owner.", "Owner: {name}, {address}", "{name}, {address}", "Nominee {name}, {address}, e-mail {email}.",  "Applied by {name}, {address}, on {date}.", "{name} ({phone}) will drive the van.", "Book the room for {name} ({email}).", "Many thanks to {name} for the lovely dinner.", "The caretaker {name} has the spare key.", "Talked to {name} on the telephone.", "The book belongs to {name}.", "Report handed over by {name}.", "Driver's name is {name}, number {phone}.",
    "{name} of {place} won the race.", "Interview with {name}, a nurse from {place}.", "Teacher {name} marked the papers.", "My neighbour {name} feeds the cat.", "His uncle {name} runs a bakery.", "According to {name}, the shop closes at {n}.", "It was {name} who found the purse.", "{name} says hello.", "{name} called about the rent.", "{name} asked for a refund.", "{name} will come again on Monday.",
    "{name} moved house. Then {known} rang twice.", "We invited {name}. {known} said yes.", "{name} is ill, so {known} stays at home.", "I wrote to {name}, and {known} answered at once.", "{name} signed first. After that {known} left the room.", "The keys were given to {name}. Please remind {known} to return them.", "Thank {name} for me. It was kind of {known} to wait.", "{name} was here. {known} will ring later.", "{name} came. It was shown to {known} again.", "My friend {given} plays chess.", "Her daughter {given} is five years old.",
    "You can ring me at {phone} in the evening.", "My phone number is {phone}.", "Cell: {phone}", "Tel: {phone}.", "Phone {phone}\n", "Fax {phone} no longer works.", "Text {phone} if you are late.", "ph. {phone}", "ph {phone}.", "mob {phone}", "tel {phone}.", "Office line {phone}, ask for the manager.", "Dial {phone} to book a table.", "For bookings call {phone} or {phone}.", "Emergency contact: {phone}.", "My new number: {phone}", "Her mobile {phone} is switched off at night.", "Missed call from {phone} again.", "{brand} {phone}", "{brand} me on {phone} tonight.", "{brand}: {phone}", "Send a message to {phone} please.",
    "\n{phone}\n", "\n{email}\n", "\n{address}\n", "\n{name}\n", "Mail the invoice to {email} by Friday.", "E-mail: {email}", "My address for letters by mail is {email}.", "Contact us: {email}.", "The link was sent to {email} this morning.", "Write a line to {email}, he replies fast.", "Login {email} is blocked.", "From {email} came no answer.", "Forward it to {email} and {email}.",
    "Aadhaar number {id} is not linked.", "PAN {id} must be quoted on the return.", "Voter card {id} was issued in {place}.", "Passport no. {id} expires soon.", "Licence {id} was found in the taxi.", "ID: {id}", "The copy of my card ({id}) is attached.", "Her document {id} was rejected.", "Member card no. {id}.", "Please update {id} in your records.", "Identity proof {id} has been verified.", "Ration card {id} got wet.", "card {id} lost", "{brand} card {id} found.", "Applied with {id} as proof.",
    "We live at {address}.", "Our new home is {address}.", "Address: {address}", "Address: {address}.", "Home address - {address}.", "She moved to {address} in winter.", "Ship the books to {address}.", "The meeting is at {address}, bring a chair.", "Resident of {address} since birth.", "Now staying at {address}.", "Please come to {address} before noon.", "Shifted from {address} to {address}.", "His residence, {address}, was sold.", "The parcel came from {address}.", "Property at {address} for rent.", "Living at {address} since {month}.", "Courier it to {address}.", "Visit us at {address} after {n}.", "The old house is at {address}.",
    "मैं {name} बोल रहा हूँ।", "मेरा नाम {name} है और मैं पढ़ता हूँ।", "श्री {name} कल आएंगे।", "{name} ने किताब लौटा दी।", "श्रीमती {name} को पुरस्कार मिला।", "{name} जी से बात हुई।", "मुझे {phone} पर फोन करना।", "मेरा पता {address} है।", "मेरा ईमेल {email} है।", "आधार संख्या {id} दर्ज है।", "पैन {id} भेज दिया।", "संपर्क: {phone}", "पता - {address}", "माझे नाव {name} आहे.", "श्री {name} यांनी अर्ज दिला.", "माझा नंबर {phone} आहे.", "আমার নাম {name}।", "ফোন নম্বর {phone}।", "என் பெயர் {name}.", "எண் {phone} அழைக்கவும்.", "నా పేరు {name}.", "నంబర్ {phone}.", "ਮੇਰਾ ਨਾਮ {name} ਹੈ।", "ਫੋਨ {phone} ਹੈ।",
)
_WITHOUT = (
    "The bus to {place} leaves at {n} every hour.", "{place} is known for its old fort.", "{place} {month} fair", "Since {month} the well is dry.", "Between {place} and {place} there is no bridge.", "Near {place} it snowed.", "We spent {n} days in {place} and {n} in {place}.", "A branch in {place} sells {brand} cheaper than elsewhere.", "{brand} tablets cost {sum} rupees for a strip.", "The {brand} printer broke after {n} pages.", "Use {brand} with care, about {n} drops in a glass.", "Parcel {code} left the depot at {place}.", "Invoice {code} dated {date} lists {n} chairs.", "Order no. {code} has been cancelled.", "The ticket {code} is valid until {date}.", "Dear Sir,\n{place} needs a new road.", "Dear madam,\n{brand} shoes are sold out.", "Hello all,\n{place} was lovely this year.", "Sincerely,\nThe {brand} team\n", "Dear officer,\n{brand} of {n} litres is too small.",
    "Batch {code} of {brand} was recalled.", "Receipt {serial} is enclosed.", "The tracking number {serial} does not work.", "Shipment number {serial} was logged.", "Serial {serial} is printed below the lid.", "Reference {serial} must be quoted.", "Docket number {serial} was entered by the clerk.", "On {date} the river rose by {n} cm.", "The match of {date} ended {n}-{n}.", "The price went from {sum} to {sum} rupees.", "It cost {sum} in all.", "Between {n} and {n} people came.", "Chapter {n} has {n} pages.", "The room is {n} by {n} feet.", "Version {n}.{n}.{n} is out.", "pH was {n}.{n} in the pool.", "About {n}.{n} percent voted.", "The clinic in {place} opens from {n} to {n}.",
    "Children from {place} sang two songs.", "The train from {place} to {place} was full.", "Village {place}, Tehsil {place}, is without power.", "Tea from {place} tastes better than {brand}.", "Most shops near {place} now sell {brand} because the older one failed.", "Traders of {place} went on strike.", "The lake near {place} dried up.", "{place} school won by {n} runs.", "People around {place} prefer {brand}.", "{brand} was tested against {brand}.", "A sample of {brand} was sent to {place}.", "{org} announced new fares.", "The {org} pays {sum} rupees a month.", "He works for {org} in {place}.", "The {brand} variety sold out.", "Brand: {brand} | Town: {place} | Colour: red | Days: {n}", "Town: {place} | Maker: {brand} | Store: {brand} | River: {place}", "town = {place}, shop = {brand}, item = {brand}; age = {n}", "Shop {brand}; street {place}; river: {place}.", "{brand} biscuits, {n} packets, from {place} market, kept near {place} station, half eaten, {n} days old", "lost: one bag of {brand} make, {n} years old, near {place} park, {brand} label, {n} kg", "Later we went home.", "The applicant must wait outside.", "Applicant number {n} is next.", "Contact the office at {n}.", "Readings were taken twice.", "Signed copies are sold out.", "Mobile phones and email are banned here.", "Regards to all.", "Name the river.", "Spring {brand} shirts, {n} pieces, bought at {brand} shop, colour no good",
    "Good morning, everybody.", "Dear Sir or Madam,\n", "Minutes of the meeting\n", "NOTICE\n", "Weekly report\n", "Please close the window.", "Rain is likely by evening.", "Nobody knows why the lift stopped.", "The tree fell on the fence and broke it.", "Sugar was short in the whole district.", "Water reached the second floor late at night.", "It is not clear whether the road will open.", "Monday is a holiday.", "In {month} the hills turn green.", "She was born in {month}.", "Room {code} is on the left.", "Plot {n} was sold.", "House prices fell by {n} percent.", "Flat shoes are in fashion again.", "Gate {n} of the market opened late.", "Bus {n} stops at Ward {n}.", "Permit {form} is pending.", "File {form} was closed.", "Sensor {form} read {n}.{n} degrees.", "Look at page {n}. The rest is easy.", "Dinner is at home. Bring rice.", "We waited at noon in {place}.", "Call us at once.", "Sold at {n} rupees a kilo.",
    "बस {place} से आती है।", "आज मौसम अच्छा है।", "किताब की कीमत {n} रुपये है।", "बच्चे मैदान में खेल रहे हैं।", "दुकान सुबह खुलती है और शाम को बंद होती है।", "पानी कम आया, इसलिए सब परेशान थे।", "आज बाजार बंद आहे.", "पाऊस खूप पडला.", "আজ বাজার বন্ধ।", "বৃষ্টি হতে পারে।", "இன்று மழை பெய்யும்.", "கடை மூடப்பட்டது.", "ఈ రోజు సెలవు.", "వర్షం పడింది.", "ਅੱਜ ਛੁੱਟੀ ਹੈ।", "ਮੀਂਹ ਪੈ ਰਿਹਾ ਹੈ।",
)


#: Plain words for loose surroundings.
_PLAIN = sorted({w for t in _WITH + _WITHOUT for w in re.findall(r"(?<![{\w])[a-z]{2,}(?![\w}])", t)})

_PLAIN_OTHER = [w for lo, hi in (("ऀ", "ॿ"), ("ঀ", "৿"), ("஀", "௿"), ("ఀ", "౿"), ("਀", "੿")) if (w := sorted({w.strip("।.,:-") for t in _WITH + _WITHOUT for w in t.split() if lo <= w[0] <= hi}))]


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        """A random word that can be said."""
        r = self.r
        out = "".join(r.choice("b bh ch d dh f g gr h j k kh l m n p pr r s sh st t tr v w y z".split()) + r.choice("a a e i o u aa ai ee oo".split()) for _ in range(r.randint(1, 3)))
        return (out + r.choice(["", "n", "r", "sh", "l", "m", "nd", "t", "k", "x"])).capitalize()

    def given(self) -> str:
        return self.r.choice(_GIVEN) if self.r.random() < 0.5 else self.word()

    def family(self) -> str:
        return self.r.choice(_FAMILY) if self.r.random() < 0.5 else self.word()

    def name(self, script: str = "") -> str:
        r, x = self.r, self.r.random()
        if script and r.random() < 0.6:
            g, f = (part.split() for part in _OTHER_SCRIPTS[script])
            return " ".join([r.choice(g), *([r.choice(g)] if r.random() < 0.15 else []), r.choice(f)])
        first = r.choice("ABCDGHJKLMNPRSTUVY")
        if x < 0.12:
            return f"{first}. {self.family()}"
        if x < 0.16:
            return f"{first}. {r.choice('ABCKMNPRSV')}. {self.family()}" if r.random() < 0.5 else f"{first}.{r.choice('ABCKMNPRSV')}. {self.family()}"
        if x < 0.2:
            return f"{self.given()} {first}. {self.family()}"
        many = 1 + (r.random() < 0.2) + (r.random() < 0.06) + (r.random() < 0.03)
        return " ".join([self.given() for _ in range(many)] + [self.family()])

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def phone(self) -> str:
        r, d = self.r, self.digits(10)
        cuts = r.choice([(5,), (3, 6), (4, 7), (4, 6, 8), (2, 6), (3,), (4,)])
        parts = [d[a:b] for a, b in zip((0, *cuts), (*cuts, 10))]
        x = r.random()
        if x < 0.22:
            t = d
        elif x < 0.5:
            t = r.choice(" -.").join(parts)
        elif x < 0.68:
            t = f"+{r.choice(['91', '91', '1', '44', '49', '971', '880'])}{r.choice(['', ' ', '-'])}{r.choice([d, r.choice(' -').join(parts)])}"
        elif x < 0.76:
            t = "0" + r.choice([d, f"{d[:2]}-{d[2:]}", f"{d[:3]}-{d[3:]}", f"{d[:4]} {d[4:]}"])
        elif x < 0.86:
            t = f"({r.choice(['0', ''])}{d[:3]}) {d[3:6]}{r.choice(' -')}{d[6:]}"
        elif x < 0.93:
            t = r.choice([" ", " ", "-", ", "]).join(_DIGITS[int(c)] for c in d)
        else:
            t = d[:8] if r.random() < 0.3 else d
        return t.translate(str.maketrans("0123456789", "०१२३४५६७८९")) if r.random() < 0.04 else t

    def id(self) -> str:
        d, a = self.digits(13), "".join(self.r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ") for _ in range(6))
        return self.r.choice([d[:12], f"{d[:4]} {d[4:8]} {d[8:12]}", f"{d[:4]}-{d[4:8]}-{d[8:12]}", f"{a[:5]}{d[:4]}{a[5]}", f"{a[:5]}{d[:4]}{a[5]}", f"{a[:3]}{d[:7]}", f"{a[:3]}{d[:7]}", f"{a[0]}{d[:7]}", f"{a[:2]}{d[:2]}{d[2:13]}"])

    def email(self) -> str:
        r = self.r
        g, f = self.given().lower(), self.family().lower()
        local = r.choice([g, f"{g}.{f}", f"{g}_{f}", f"{g}{self.digits(2)}", f"{f}-{self.digits(4)}", f"{g}+{self.word().lower()}", f"{g[0]}{f}", f"{g}.{f[0]}{self.digits(1)}"])
        domain = [r.choice([self.word().lower(), f"{self.word().lower()}{r.choice(['mail', 'net', 'post', 'web'])}", f"{self.word().lower()}-{self.word().lower()}"]), *r.choice([["com"], ["org"], ["in"], ["net"], ["co", "in"], ["gov", "in"], ["example"], ["org", "uk"], ["edu"], ["invalid"], ["test"], ["ac", "example"]])]
        x = r.random()
        if x < 0.6:
            t = f"{local}@{'.'.join(domain)}"
        else:
            a, b = r.choice([("(", ")"), ("[", "]"), ("{", "}"), ("<", ">")])
            t = r.choice([f"{local} at {' dot '.join(domain)}", f"{local}{a}at{b}{f'{a}dot{b}'.join(domain)}", f"{local} {a}at{b} {'.'.join(domain)}", f"{local} {a}at{b} {f' {a}dot{b} '.join(domain)}", f"{local} @ {'.'.join(domain)}", f"{local} at {'.'.join(domain)}"])
        return t.upper() if r.random() < 0.08 else t

    def street(self) -> str:
        r = self.r
        name = r.choice([self.word(), self.family(), r.choice("Gandhi Nehru Station Temple Park Church Market Lake Hill Mill MG JN RK".split()), f"{self.word()} {self.word()}"])
        return f"{name} {r.choice(_STREETS)}"

    def address(self) -> str:
        r = self.r
        n, m = r.randint(1, 999), r.randint(1, 60)
        letter = r.choice("ABCDEF")
        number = r.choice([f"{n}", f"{n}", f"{n}/{m}", f"{n}-{m}", f"{n}{letter}", f"{n}-{letter}", f"{letter}-{m}", f"{letter}/{m}"])
        house = r.choice(["", "", "", "No. ", "no. ", "#", "House No. ", "House ", "H.No. ", "H. No. ", "Flat ", "Flat No. ", "Plot ", "Plot No. ", "Door No. ", "Door no. ", "D.No. ", "Room ", "Shop No. ", "Quarter ", "Villa "])
        head = f"{house}{number}"
        x = r.random()
        if x < 0.1:
            head = f"{self.word()} {r.choice(_BUILDINGS)}"  # a house with a name, no number
        elif x < 0.25:
            head += f"{r.choice([', ', ' '])}{self.word()} {r.choice(_BUILDINGS)}"
        town = self.town()
        rest = r.choice([[self.street()], [self.street()], [self.street()], [self.street(), self.town()], [self.word()], [f"{r.choice(['1st', '2nd', '3rd', '4th', '9th'])} {r.choice(['Cross', 'Main', 'Street', 'Floor', 'Block'])}", self.street()], [f"Ward {m}"], [self.street(), f"Ward {m}"], [self.street(), f"{r.choice(['near', 'opp.', 'behind', 'opposite'])} {self.word()} {r.choice('temple school bank hospital station church mosque park'.split())}"], [self.street(), f"{r.choice(['Post', 'P.O.', 'Taluk', 'Dist.'])} {self.town()}"], [f"Sector {m}"]])
        pin = str(r.randint(1, 9)) + self.digits(5)
        tail = r.choice([f"{town} {pin}", f"{town} {pin}", f"{town} - {pin}", f"{town}-{pin}", f"{town}, {pin}", town, town, f"{town}, {self.town()} {pin}", f"{town} {pin[:3]} {pin[3:]}"])
        gap = ", " if r.random() < 0.5 or not head[-1].isdigit() or x < 0.25 else " "
        return head + gap + ", ".join([*rest, tail])

    def town(self) -> str:
        return self.r.choice(_PLACES) if self.r.random() < 0.3 else self.word()

    def other(self, kind: str) -> str:
        r, n = self.r, self.r.randint(1, 98)
        if kind == "place":
            return f"{r.choice(['New', 'Old', 'North', 'Port'])} {self.town()}" if r.random() < 0.05 else self.town()
        if kind == "brand":
            return self.word() + (r.choice([" Plus", " Gold", f" {n}"]) if r.random() < 0.06 else "")
        if kind == "org":
            return f"{self.word()} {r.choice('Bank Society Railway Board Council Club Company Trust'.split())}"
        if kind == "code":
            return r.choice([f"{self.digits(4)}-{n}", f"{self.digits(3)}-{n}", f"{self.digits(4)}", f"{r.choice('ABKX')}{n}"])
        if kind == "form":
            return f"{''.join(r.choice('ABDKMRTXZ') for _ in range(r.randint(1, 3)))}/{self.digits(r.randint(3, 5))}"
        if kind == "serial":
            return self.digits(9) if r.random() < 0.8 else self.digits(r.choice([7, 8]))
        if kind == "sum":
            return r.choice([f"{n},{self.digits(3)}", f"{n},{self.digits(2)},{self.digits(3)}", self.digits(4).lstrip("0") or "7"])
        if kind == "month":
            return r.choice(_MONTHS)
        if kind == "date":
            d, m, y = n % 28 + 1, n % 12 + 1, r.randint(1990, 2025)
            return r.choice([f"{d:02d}/{m:02d}/{y}", f"{y}-{m:02d}-{d:02d}", f"{d} {r.choice(_MONTHS)} {y}", f"{d:02d}-{m:02d}-{y}", f"{d}.{m}.{y}"])
        return str(n)

    def loose(self) -> str:
        """A template of common words in random order around some slot: surroundings that no sentence above has."""
        r = self.r
        if r.random() < 0.25:
            words = r.choice(_PLAIN_OTHER)
            return " ".join(r.choice(words) for _ in range(r.randint(3, 8))) + r.choice(["।", ".", "?", "\n", ""])
        if r.random() < 0.15:  # a list that is no address
            w = lambda: r.choice(_PLAIN)
            items = [r.choice([f"{{n}} {w()}", f"{w()} {{brand}}", f"{{brand}} {w()}", f"{{brand}} {w()} {w()}", f"{w()} {w()} {{place}}", f"{w()} {{place}} {w()}", f"{w()} {w()} {w()}", f"{{n}} {w()} {w()}", f"{w()} {{n}} {w()}", f"{w()} {{n}} {w().upper()}"]) for _ in range(r.randint(3, 7))]
            return ", ".join(items) + r.choice([".", ".", "\n"])
        if r.random() < 0.15:  # a given name again
            w = lambda k: " ".join(r.choice(_PLAIN) for _ in range(k))
            return f"{w(2).capitalize()} {{name}} {w(2)}. {r.choice([w(1).capitalize() + ' ', w(3).capitalize() + ' ', ''])}{{known}} {w(3)}."
        if r.random() < 0.15:
            lead = r.choice(_ROLES if r.random() < 0.6 else _WHEN)
            rest = " ".join(r.choice(_PLAIN) for _ in range(r.randint(1, 4)))
            if r.random() < 0.25:
                return f"{r.choice(['The', 'Our', 'His', 'Her', 'A'])} {r.choice(_ROLES).lower()}, {{name}}, {rest}."
            return f"{lead if r.random() < 0.8 else lead.lower()} {{name}} {rest}."
        slot = r.choice(["{name}", "{name}", "{name}", "{place}", "{place}", "{brand}", "{brand}", "{place}", "{phone}", "{address}", "{email}", "{id}", "{serial}", "{n} {brand}", "{org}"])
        before, after = ([r.choice(_PLAIN) for _ in range(r.choice((0, 1, 1, 2, 3)) if a else r.randint(1, 3))] for a in (1, 0))
        if before:
            before[0] = before[0].capitalize()
        mark = r.choice([" ", " ", " ", " ", ", ", ": ", " - ", "; "])
        return " ".join(before) + r.choice([" ", " ", " ", " ", ", ", ": ", " ("] if before else [""]) + slot + mark + " ".join(after) + r.choice([".", ".", ".", "", "\n"])

    def fill(self, template: str) -> tuple[str, list[tuple[int, int, str]], list[str]]:
        """(text, segments, given names that the text gives in full)."""
        out, spans, at, last = "", [], 0, ""
        kinds = {"name": "person_name", "given": "person_name", "known": "person_name", "phone": "phone", "id": "id_number", "email": "email", "address": "address"}
        script = next((k for k, (lo, hi) in {"hi": "ऀॿ", "bn": "ঀ৿", "ta": "஀௿", "te": "ఀ౿", "pa": "਀੿"}.items() if any(lo <= c <= hi for c in template)), "")
        full = []
        for m in re.finditer(r"\{(\w+)\}", template):
            out += template[at : m.start()]
            at, k = m.end(), m.group(1)
            if k in kinds:
                value = self.name(script) if k == "name" else last if k == "known" else getattr(self, k)()
                if k == "name":
                    while "{known}" in template and "." in value:
                        value = self.name(script)
                    last = value.split()[0]
                    full.append(last.lower())
                spans.append((len(out), len(out) + len(value), kinds[k]))
            else:
                value = self.other(k)
            out += value
        return out + template[at:], spans, full


def fixed_parts() -> list[str]:
    """What the sentences say besides the segments and fillings."""
    return [p for t in _WITH + _WITHOUT for p in re.split(r"\{\w+\}", t)]


def generated(n: int, seed: int = 11) -> list[tuple[str, list[tuple[int, int, str]], list[str]]]:
    """n short texts of one to three sentences, some of them in one case: (text, segments as characters, known given names)."""
    maker, out = _Maker(seed), []
    r = maker.r
    for _ in range(n):
        text, gold, names = "", [], []
        for _ in range(r.randint(1, 3)):
            x = r.random()
            part, spans, full = maker.fill(r.choice(_WITH) if x < 0.5 else r.choice(_WITHOUT) if x < 0.8 else maker.loose())
            if text:
                text += "" if text.endswith("\n") else " "
            gold += [(s + len(text), e + len(text), k) for s, e, k in spans]
            names += full
            text += part
        x = r.random()
        if x < 0.1 and text.isascii():
            text = text.lower()
        elif x < 0.15 and text.isascii():
            text = text.upper()
        out.append((text, gold, names))
    return out


def lexicon() -> frozenset[str]:
    """The common words of the sentences."""
    own = {w for p in fixed_parts() for w in re.findall(r"(?<!\w)(?:[a-z]{2,}|[^\W\d_a-zA-Z][\w]*)(?!\w)", p)}
    own |= {w.lower() for p in fixed_parts() for w in re.findall(r"[A-Z][a-z]+", p)} - {"monday", "friday", "aadhaar", "tehsil", "pan"}
    return frozenset(own | {w.lower() for w in _ROLES + _WHEN} | {w.lower() for w in _STREETS if len(w) > 3} | set("house flat plot door room shop near behind opposite temple school bank hospital station church mosque park market lake hill mill ward post floor block main cross".split()))


def examples(n: int, seed: int = 11) -> list[tuple[list[Candidate], set[tuple[int, int, str]]]]:
    """The texts as candidates and true segments (in tokens); one common word in 30 is taken for an unknown one."""
    r, out, words = random.Random(seed), [], sorted(lexicon())
    for text, gold, names in generated(n, seed):
        t = Text(text, frozenset(w for w in words if r.random() > 0.03))
        known = frozenset(names)  # as in the second pass
        start, end = {s: k for k, s in enumerate(t.starts)}, {e: k + 1 for k, e in enumerate(t.ends)}
        out.append((list(candidates(t, known)), {(start[s], end[e], k) for s, e, k in gold if s in start and e in end}))
    return out
