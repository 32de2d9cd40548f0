"""Hand-made raw files of one year (and a 2019 users file), see the cases in test_accidents."""

import os

CIRC = ["Num_Acc", "jour", "mois", "an", "hrmn", "lum", "dep", "com", "agg", "int", "atm", "col",
        "adr", "lat", "long"]
LOC = ["Num_Acc", "catr", "voie", "v1", "v2", "circ", "nbv", "vosp", "prof", "pr", "pr1", "plan",
       "lartpc", "larrout", "surf", "infra", "situ", "vma"]
VEH = ["Num_Acc", "id_vehicule", "num_veh", "senc", "catv", "obs", "obsm", "choc", "manv", "motor",
       "occutc"]
USR = ["Num_Acc", "id_usager", "id_vehicule", "num_veh", "place", "catu", "grav", "sexe", "an_nais",
       "trajet", "secu1", "secu2", "secu3", "locp", "actp", "etatp"]


def circ(acc, **k):
    row = dict(Num_Acc=acc, jour=2, mois=1, an=2023, hrmn="12:00", lum=1, dep="75", com="75116", agg=1,
               int=1, atm=1, col=1, adr="rue", lat="48,85", long="2,35")
    return row | k


def loc(acc, **k):
    row = dict(Num_Acc=acc, catr=3, voie="D1", v1=0, v2="A", circ=2, nbv="2", vosp=0, prof=1, pr="1",
               pr1="0", plan=1, lartpc="", larrout="", surf=1, infra=0, situ=1, vma=50)
    return row | k


def veh(acc, vid, catv, **k):
    row = dict(Num_Acc=acc, id_vehicule=vid, num_veh="A01", senc=1, catv=catv, obs=0, obsm=2, choc=1,
               manv=1, motor=1, occutc="")
    return row | k


def usr(acc, uid, vid, catu=1, grav=1, **k):
    row = dict(Num_Acc=acc, id_usager=uid, id_vehicule=vid, num_veh="A01", place=1, catu=catu, grav=grav,
               sexe=1, an_nais=1983, trajet=1, secu1=1, secu2=0, secu3=-1, locp=-1, actp="-1", etatp=-1)
    return row | k


def tables():
    c, l, v, u = [], [], [], []

    def plain(acc, locations=1, **k):
        c.append(circ(acc, **k))
        if locations:
            l.append(loc(acc))

    plain(1)
    v += [veh(1, "11", 7), veh(1, "12", 15)]
    u += [usr(1, "101", "11"), usr(1, "102", "12")]
    plain(2)
    v += [veh(2, "21", 1)]
    u += [usr(2, "201", "21")]
    plain(3)
    v += [veh(3, "31", 7)]
    u += [usr(3, "301", "31"), usr(3, "302", "31", catu=3, grav=3)]
    plain(4)
    v += [veh(4, "41", 33), veh(4, "42", 7), veh(4, "43", 7)]
    u += [usr(4, "401", "41"), usr(4, "402", "42"), usr(4, "403", "43")]
    c.append(circ(5))
    l += [loc(5, vma=80), loc(5, vma="", catr="")]
    v.append(veh(5, "51", 7)); u.append(usr(5, "501", "51"))
    c.append(circ(6))
    l += [loc(6, catr=4), loc(6, catr=2)]
    v.append(veh(6, "61", 7)); u.append(usr(6, "601", "61"))
    for acc, vma in ((7, 500), (8, "")):
        c.append(circ(acc)); l.append(loc(acc, vma=vma))
        v.append(veh(acc, f"{acc}1", 7)); u.append(usr(acc, f"{acc}01", f"{acc}1"))
    plain(9, jour=30, mois=2)
    v.append(veh(9, "91", 7)); u.append(usr(9, "901", "91"))
    plain(10)
    v.append(veh(10, "1001", 7)); u.append(usr(10, "10001", "1001", grav=-1))
    plain(11)
    v.append(veh(11, "1101", 7))
    u += [usr(11, "11001", "1101", an_nais=1923), usr(11, "11002", "1101", catu=2, an_nais="")]
    for i, t in enumerate(["05:59", "06:00", "09:59", "10:00", "15:59", "16:00", "19:59", "20:00"]):
        acc = 120 + i
        plain(acc, hrmn=t)
        v.append(veh(acc, f"{acc}1", 7)); u.append(usr(acc, f"{acc}01", f"{acc}1"))
    plain(13)
    v.append(veh(13, "1301", 33)); u.append(usr(13, "13001", "1301", secu1=7))
    c.append(circ(14, int=3)); l.append(loc(14, nbv="#VALEURMULTI", catr=4, circ=-1))
    v.append(veh(14, "1401", 7)); u.append(usr(14, "14001", "1401"))
    c.append(circ(15, int=6)); l.append(loc(15, nbv="12", catr=4, circ=4))
    v.append(veh(15, "1501", 7)); u.append(usr(15, "15001", "1501"))
    plain(16)
    v.append(veh(16, "138 306 524", 7)); u.append(usr(16, "16 001", "138 306 524"))
    plain(17)
    v.append(veh(17, "", 7)); u.append(usr(17, "17001", ""))
    plain(18)
    v.append(veh(18, "1801", -1)); u.append(usr(18, "18001", "1801"))
    plain(19, locations=0)
    v.append(veh(19, "1901", 7)); u.append(usr(19, "19001", "1901"))
    plain(20)
    return c, l, v, u


def write(folder, year=2023):
    os.makedirs(folder, exist_ok=True)

    def put(name, columns, rows):
        with open(f"{folder}/{name}-{year}.csv", "w", encoding="utf-8") as f:
            f.write(";".join(columns) + "\n")
            for r in rows:
                f.write(";".join(str(r[k]) for k in columns) + "\n")
    c, l, v, u = tables()
    put("characteristics", CIRC, c)
    put("locations", LOC, l)
    put("vehicles", VEH, v)
    put("users", USR, u)


def write_old_users(folder):
    """A 2019 set in which users have no user id."""
    def put(name, columns, rows):
        with open(f"{folder}/{name}-2019.csv", "w", encoding="utf-8") as f:
            f.write(";".join(columns) + "\n")
            for r in rows:
                f.write(";".join(str(r[k]) for k in columns) + "\n")
    put("characteristics", CIRC, [circ(900, an=2019)])
    put("locations", LOC, [loc(900)])
    put("vehicles", VEH, [veh(900, "9001", 7)])
    put("users", [k for k in USR if k != "id_usager"],
        [usr(900, None, "9001", sexe=1), usr(900, None, "9001", catu=2, sexe=2)])
