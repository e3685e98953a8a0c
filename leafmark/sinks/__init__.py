"""Writers: page files, works, vector blocks, serving database, reports."""
