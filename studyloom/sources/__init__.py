"""Sources: imaging headers, archives, workbooks, listings and path lists; and the sinks of reports."""
