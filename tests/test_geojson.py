from alluvia.sources.geojson import encoding_of, guessed, read_geojson

TEXT = '{"type": "FeatureCollection", "features": [{"properties": {"name": "é"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}'


def test_guesses():
    assert guessed("Überschwemmungsfläche über Köln".encode("cp1252"))[0] == "cp1252"
    assert encoding_of("затопленные территории".encode("cp1251")) == "cp1251"
    assert encoding_of(bytes(range(128, 256))) == "latin-1"


def test_encodings(spark, tmp_path):
    for name in ("utf-8", "utf-8-sig", "utf-16", "latin-1"):
        assert encoding_of(TEXT.encode(name)) == {"latin-1": "cp1252"}.get(name, name)
        (tmp_path / f"{name}.geojson").write_bytes(TEXT.encode(name))
    (tmp_path / "bad.geojson").write_bytes(b'{"features": \x01}')
    (tmp_path / "none.geojson").write_bytes(b"")
    rows = {r.file.rsplit("/", 1)[1]: r for r in read_geojson(spark, str(tmp_path)).collect()}
    assert len(rows) == 5 and rows["bad.geojson"].encoding == "binary" and rows["bad.geojson"].properties is None
    for name in ("utf-8", "utf-8-sig", "utf-16", "latin-1"):
        assert "é" in rows[f"{name}.geojson"].properties and "Point" in rows[f"{name}.geojson"].geometry
