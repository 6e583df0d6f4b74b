"""A greenhouse used by several tests: one moisture sensor, wired to one probe."""

ENTITY_ID = "sensor.north_bench"
DEVICE_ID = "probe-17"
#: In the order that documents list them.
ENTITY_LABELS = ["plants", "wet"]
DEVICE_LABELS = ["battery", "outdoor", "spare"]

ENTITY = {
    "entity_id": ENTITY_ID,
    "domain": "sensor",
    "object_id": "north_bench",
    "name": "Moisture of the north bench",
    "original_name": "channel 0",
    "device_class": "moisture",
    "original_device_class": "humidity",
    "platform": "serial",
    "unit_of_measurement": "%",
}
FLOORS = [{"floor_id": "ground", "name": "Ground"}, {"floor_id": "gallery", "name": "Gallery"}]


def areas(entity_floor=True, device_floor=True):
    """The bench where the sensor is and the shed where the probe hangs, on a floor each or on none."""
    return [
        {"id": "bench", "name": "Bench", "floor_id": "ground" if entity_floor else None},
        {"id": "shed", "name": "Shed", "floor_id": "gallery" if device_floor else None},
    ]


def entity(area=True, labels=True, device_id=DEVICE_ID):
    placed = {"area_id": "bench" if area else None, "device_id": device_id}
    return {**ENTITY, **placed, "labels": ENTITY_LABELS[::-1] if labels else []}


def device(area=True, labels=True):
    placed = {"area_id": "shed" if area else None, "labels": DEVICE_LABELS[::-1] if labels else []}
    return {"id": DEVICE_ID, "name": "Probe", **placed}
