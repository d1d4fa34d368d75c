"""Pages whose judged nodes are labelled: (page, texts that are content, texts that aren't)."""

P1 = "The ferry to the island leaves twice a day in summer, and once in winter. Tickets are sold on board, but only for cash."
P2 = "In the harbour stands an old lighthouse, built in 1873 by two brothers from the mainland. It has been dark since the war, though its lamp still works."
P3 = "Most visitors walk along the coast, where seals can be seen at low tide. The path is steep, so good shoes are advised."
P4 = "The museum was closed for years. It opened again last spring, with a new hall for the paintings, a library, and a small cafe."
P5 = "We measured the flow at three depths. At the surface it was fast, at the bottom slow; in between it changed with the wind."

PAGES = (
    (f"<html><body><div class='menu'>Home About Contact</div><p>{P1}</p><p>{P2}</p><div>Copyright 2020</div></body></html>", (P1, P2), ("Home About Contact", "Copyright 2020")),
    (f"<body><div id='top'>News | Weather | Sport | Travel</div><div class='text'><p>{P1}</p><p>{P3}</p></div><div class='ad'>Buy new boots now! 50 % off.</div></body>", (P1, P3), ("News | Weather | Sport | Travel", "Buy new boots now! 50 % off.")),
    (f"<main><p>{P2}</p><p>{P4}</p><p>{P5}</p></main><aside>Subscribe to our newsletter today</aside><footer>All rights reserved. Imprint</footer>", (P2, P4, P5), ("Subscribe to our newsletter today", "All rights reserved. Imprint")),
    (f"<div class='nav'>Start Shop Help Login</div><article><p>{P3}</p><div class='share'>Share this page</div><p>{P1}</p></article><div class='cookies'>We use cookies. Accept</div>", (P3, P1), ("Start Shop Help Login", "Share this page", "We use cookies. Accept")),
    (f"<body><div class='col1'><div>Topics</div><div>Archive</div><div>Authors</div></div><div class='col2'>{P4}<br><br>{P5}</div><div class='legal'>(c) 2011 Island Press</div></body>", (P4, P5), ("Topics", "Archive", "Authors", "(c) 2011 Island Press")),
    (f"<body><p class='lead'>A short walk, a long view.</p><p>{P1}</p><p>{P2}</p><p>{P3}</p><div class='promo'>Book your room here</div></body>", (P1, P2, P3), ("Book your room here",)),
    (f"<body><form>Search Name Password</form><section><p>{P5}</p></section><div class='related'>More on this topic</div><div class='related'>Ten best beaches</div></body>", (P5,), ("Search Name Password", "More on this topic", "Ten best beaches")),
    (f"<body><div class='head'>The Island Post</div><div class='body'>{P2} {P4}</div><div class='foot'>Printed from www.island.example</div></body>", (f"{P2} {P4}",), ("The Island Post", "Printed from www.island.example")),
)
