"""Views that map the test tables onto the retail data model."""
