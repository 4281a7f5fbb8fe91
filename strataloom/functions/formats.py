"""Formats shared by everything that writes or reads JSON."""

# Time patterns down to the microsecond.  Without them JSON keeps
# milliseconds only and a value does not survive the way out and back.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
