"""Table, file and page inputs; outbox, ledger and log outputs."""
